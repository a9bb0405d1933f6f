"""Relational operators. None of them touches the network, the disk or a codec; see ``adapters`` and ``sources``."""
