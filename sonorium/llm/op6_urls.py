"""URL filters: all glob rules at once by a bit-parallel wildcard automaton.

Every rule's states lie side by side in one multiword bit vector (Shift-And). A step over one character
of the canonical URL shifts all states by one bit, masks them with that character's words and keeps those
that stand before a star, so the cost of a character doesn't depend on which rules are alive. Steps run
over a whole Arrow batch of URLs together, the longest first, one vector operation a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: name -> glob over the whole canonical URL; * is any run of characters, ? any one character.
RULES: dict[str, str] = {
    **{f"spam:{n}": g for d in ("spam-farm", "cheap-pills", "free-bets", "casino-win", "replica-watch", "payday-loan", "miracle-diet") for n, g in ((d, f"*://{d}.*"), (f"{d}/sub", f"*://*.{d}.*"))},
    **{f"ads:{d}": f"*://*{d}*/*" for d in ("ads-track", "adserver.", "doubleclick.", "popunder", "clickbank.")},
    **{f"adult:{w}": f"*{w}*" for w in ("porn", "xxx-", "escort-", "hentai")},
    **{f"file:{x}": f"*.{x}" for x in ("exe", "zip", "tar.gz", "iso", "dmg", "apk", "jpg", "jpeg", "png", "gif", "mp4", "mp3", "css", "js")},
    **{f"page:{p}": f"*/{p}*" for p in ("login", "signin", "wp-admin/", "cgi-bin/", "cart", "checkout", "unsubscribe", "calendar/??/", "search?q=")},
    "query:session": "*?*sessionid=*",
    "query:deep-page": "*page=??*",
    "host:ip": "*://?.?.?.?/*",
    "host:ip-long": "*://??*.??*.??*.??*:*/*",
    "scheme:ftp": "ftp://*",
    "path:repeat": "*/a/a/a/*",
}

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)"
_TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical(url: Column) -> Column:
    """The canonical form of a URL; null stays null.

    Spaces around and the fragment go; scheme and host are lower-cased; the host loses ``www.``, the
    default ports and user names; the path loses final slashes; the query loses tracking parameters and
    empty parts and is sorted. A text without scheme only loses spaces and fragment.
    """
    u = F.regexp_replace(F.trim(url), r"#[\s\S]*$", "")
    scheme = F.lower(F.regexp_extract(u, _SCHEME, 1))
    host = F.lower(F.regexp_extract(u, _SCHEME, 2))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, _SCHEME, 3), r"/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?([\s\S]*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(_TRACKING)))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(scheme == "", u).otherwise(F.concat(scheme, F.lit("://"), host, path, query))


class GlobSet:
    """Glob rules packed into words of 64 states."""

    def __init__(self, globs: list[str]) -> None:
        rules = []
        for g in globs:
            taken: list[str | None] = [None]  # what is read on the way into each state; state 0 can't be entered
            loops = set()
            for ch in g:
                if ch == "*":
                    loops.add(len(taken) - 1)
                else:
                    taken.append(ch)
            rules.append((taken, loops))
        letters = sorted({c for t, _ in rules for c in t[1:] if c != "?"})
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        n = sum(len(t) for t, _ in rules)
        self.words = max(1, -(-n // 64))
        masks = np.zeros((len(letters) + 1, self.words), np.uint64)  # the last is any other character
        self.start, self.loop = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.final = []
        at = 0
        for taken, loops in rules:
            for s, ch in enumerate(taken):
                w, bit = divmod(at + s, 64)
                bit = np.uint64(1 << bit)
                if s == 0:
                    self.start[w] |= bit
                elif ch == "?":
                    masks[:, w] |= bit
                else:
                    masks[letters.index(ch), w] |= bit
                if s in loops:
                    self.loop[w] |= bit
            at += len(taken)
            self.final.append(divmod(at - 1, 64))
        self.masks = masks

    def match(self, urls: list[str]) -> list[list[int]]:
        """Numbers of the rules that match each URL, ascending."""
        if not urls:
            return []
        length = np.array([len(u) for u in urls])
        order = np.argsort(-length, kind="stable")
        length = length[order]
        codes = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.concatenate([[0], np.cumsum([len(u) for u in urls])])[:-1][order]
        kind = np.searchsorted(self.letters, codes)
        known = kind < len(self.letters)
        known[known] = self.letters[kind[known]] == codes[known]
        kind = np.where(known, kind, len(self.letters))
        state = np.tile(self.start, (len(urls), 1))
        top, one = np.uint64(63), np.uint64(1)
        for t in range(int(length[0])):
            live = int(np.searchsorted(-length, -t, "left"))  # the URLs longer than t
            d = state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            moved &= self.masks[kind[first[:live] + t]]
            moved |= d & self.loop
            state[:live] = moved
        hit = np.stack([(state[:, w] >> np.uint64(b)) & one for w, b in self.final], 1).astype(bool) if self.final else np.zeros((len(urls), 0), bool)
        out: list[list[int]] = [[] for _ in urls]
        for row, rule in zip(*np.nonzero(hit)):
            out[order[row]].append(int(rule))
        return out


def filter_urls(pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """(page_id, canonical_url, rules, blocked) of every row of pages.

    ``rules`` lists the names of the rules that match, sorted; ``blocked`` says whether any does. A null
    URL stays null and is not blocked; an empty one is matched as it is. Repeated rows are judged alike,
    an empty table gives no rows, other columns are ignored.
    """
    rules = RULES if rules is None else rules
    names = sorted(rules)
    globs = [rules[n] for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = GlobSet(globs)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                urls = part.column("canonical_url")
                found = machine.match(pc.fill_null(urls, "").to_pylist())
                live = pc.is_valid(urls).to_pylist()
                hits = [[names[i] for i in f] if ok else [] for f, ok in zip(found, live)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), urls, pa.array(hits, pa.list_(pa.string())), pa.array([bool(h) for h in hits])], ["page_id", "canonical_url", "rules", "blocked"])

    todo = pages.select("page_id", canonical(F.col("url").cast("string")).alias("canonical_url"))
    kind = todo.schema["page_id"].dataType.simpleString()
    return todo.mapInArrow(run, f"page_id {kind}, canonical_url string, rules array<string>, blocked boolean")
