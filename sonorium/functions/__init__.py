"""Scalar functions: pure ``Column -> Column``, all of them JVM-side."""
