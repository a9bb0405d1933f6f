"""Secret scans: values in a credential context, judged by how many guesses they would take.

A context is a credential word (password, token, api key ...) with ``=`` or ``:`` and a value after it: all
between a quotation mark and the next of its kind on the line, or without one what stands up to white space.
Each value is cut into the segments that an attacker would guess most cheaply, by dynamic programming over
all segmentations into known words (with capitals, reversal and look-alike digits), dates, repeated units,
keyboard walks and brute-force spans. A value that still needs ``SECRET`` decades of guesses is a secret; words
and placeholders are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import comb, log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import chunks

#: Decades of guesses from which a value counts as a secret.
SECRET = 8.0
KEYS = r"passwords?|passwd|pwd|passphrase|secret|token|api[_\-]?key|access[_\-]?key|auth[_\-]?key|private[_\-]?key|credentials?"
#: Java and Python differ in what white space is, so texts are only asked for the word itself beforehand.
_PREFILTER = rf"(?iu)(?:{KEYS})"
#: A quoted value; a mark that a joining operator follows closes a string of source code.
_QUOTED = r"\"(?!\s+[+.&|]\s)(?P<double>(?:[^\"\\\r\n]|\\.)++)\"|'(?!\s+[+.&|]\s)(?P<single>(?:[^'\\\r\n]|\\.)++)'"
#: What ends a bare value besides white space: a mark that closes, an HTML tag, the next name of a list of settings.
_STOP = r"[\"'](?=[\s,;:)\]}>]|\Z)|</[a-z]|<(?:br|hr|p|div|span|li|td|tr|a|b|i|em|strong|code)\b[^<>\n]*>|[,;](?=[\"']?[a-z_][\w.\-]{1,40}[\"']?\s*[:=])"
_CONTEXT = re.compile(rf"(?i)(?P<key>{KEYS})[\"']?\s*[:=]+>?\s*(?:{_QUOTED}|[\"']?(?![\"'])(?P<bare>(?:(?!{_STOP})\S)++))")
_PAIRS = {")": "(", "]": "[", "}": "{", ">": "<"}

#: Common passwords and words, most common first; the rank is the number of guesses.
WORDS = (
    "password 123456 12345678 qwerty 123456789 12345 1234 111111 1234567 dragon 123123 baseball abc123 football monkey letmein shadow master "
    "666666 qwertyuiop 123321 mustang 1234567890 michael 654321 superman 1qaz2wsx 7777777 121212 000000 qazwsx 123qwe killer trustno1 jordan "
    "jennifer zxcvbnm asdfgh hunter buster soccer harley batman andrew tigger sunshine iloveyou 2000 charlie robert thomas hockey ranger daniel "
    "starwars klaster 112233 george computer michelle jessica pepper 1111 zxcvbn 555555 11111111 131313 freedom 777777 pass maggie 159753 aaaaaa "
    "ginger princess joshua cheese amanda summer love ashley nicole chelsea biteme matthew access yankees 987654321 dallas austin thunder taylor "
    "matrix admin administrator root test guest user default changeme change secret token welcome hello login example sample placeholder your my "
    "none null true false todo here insert value key redacted hidden xxxx the and for that with this from have not are was you all new one two "
    "time day year good word work home house world water light night green blue black white north south spring winter autumn apple orange correct "
    "horse battery staple moon star river stone fire cloud king queen tiger eagle lion happy open sesame magic coffee music"
).split()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
_LONGEST = max(map(len, WORDS))
_LOOKS = str.maketrans("4@8310!57$", "aabeloists")
_DATE = (re.compile(r"(\d{4})([-/._]?)(\d{1,2})\2(\d{1,2})"), re.compile(r"(\d{1,2})([-/._]?)(\d{1,2})\2(\d{4}|\d{2})"))
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
#: Keys of the longest keyboard walk that is one segment; a longer one is taken as several, at the cost of each.
_LONGEST_WALK = 40


#: (row, column) of every key.
_SPOT = {c: (r, i + (r > 0)) for r, row in enumerate(_ROWS) for i, c in enumerate(row)}


def _neighbours() -> dict[str, set[str]]:
    near = lambda a, b: abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1 and a != b
    return {c: {d for d in _SPOT if near(_SPOT[c], _SPOT[d])} for c in _SPOT}


NEAR = _neighbours()


def word_cost(s: str) -> float | None:
    """Decades of guesses for a whole string as a known word; None if it is none."""
    low = s.lower()
    best = None
    for form, extra in ((low, 1), (low[::-1], 2), (low.translate(_LOOKS), 2)):
        rank = RANK.get(form)
        if rank is not None:
            up = sum(c.isupper() for c in s)
            case = 1 if not up else 2 if up == len(s) or (up == 1 and s[0].isupper()) else sum(comb(len(s), k) for k in range(1, min(up, len(s) - up) + 1))
            best = min(best or 1e300, rank * extra * case)
    return None if best is None else log10(best + 1)


def date_cost(s: str) -> float | None:
    """Decades of guesses for a whole string as a date with a plausible month and day."""
    best = None
    for i, p in enumerate(_DATE):
        m = p.fullmatch(s)
        if not m:
            continue
        y, a, b = (m[1], m[3], m[4]) if i == 0 else (m[4], m[1], m[3])
        year = int(y) if len(y) == 4 else 1900 + int(y) if int(y) > 50 else 2000 + int(y)
        a, b = int(a), int(b)
        if 1900 <= year <= 2050 and ((1 <= a <= 12 and 1 <= b <= 31) or (1 <= b <= 12 and 1 <= a <= 31)):
            cost = log10(365 * max(abs(year - 2025), 20) * (4 if m[2] else 1))
            best = cost if best is None else min(best, cost)
    return best


@lru_cache(None)
def _walk_guesses(n: int, turns: int) -> float:
    return log10(sum(comb(i - 1, j - 1) * len(NEAR) * 5.0**j for i in range(2, n + 1) for j in range(1, min(turns, i - 1) + 1)))


def walk_cost(s: str) -> float | None:
    """Decades of guesses for a whole string as a walk over neighbouring keys, three keys at least."""
    low = s.lower()
    if len(s) < 3 or any(b not in NEAR.get(a, ()) for a, b in zip(low, low[1:])):
        return None
    spots = [_SPOT[c] for c in low]
    steps = [(r - p, c - q) for (p, q), (r, c) in zip(spots, spots[1:])]
    turns = 1 + sum(x != y for x, y in zip(steps, steps[1:]))
    return _walk_guesses(min(len(s), _LONGEST_WALK), turns) + (0.5 if low != s else 0.0)


def _alike(s: str, i: int, j: int) -> int:
    """Length of the longest common prefix of s[i:] and s[j:], j > i."""
    most, step = len(s) - j, 1
    while step < most and s[i : i + step] == s[j : j + step]:
        step *= 2
    low, high = step // 2, min(step, most)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if s[i + low : i + mid] == s[j + low : j + mid] else (low, mid - 1)
    return low


def runs(s: str) -> set[tuple[int, int, int]]:
    """(start, end, period) of every maximal repetition, twice its period long at least.

    Each one's root is, in one of the two orders of the alphabet, the longest Lyndon word at some place. There are
    fewer than len(s), whatever their periods.
    """
    n, back, out = len(s), s[::-1], set()
    for up in (True, False):
        end = [n] * n  # of the longest Lyndon word from here
        for i in range(n - 1, -1, -1):
            j = i + 1
            while j < n:
                k = _alike(s, i, j)
                if j + k == n or (s[i + k] < s[j + k]) != up:
                    break
                j = end[j]
            end[i] = j
            p = j - i
            if j < n:
                before = _alike(back, n - j, n - i) if i else 0
                after = _alike(s, i, j)
                if before + after >= p:
                    out.add((i - before, j + after, p))
    return out


def repeats(s: str) -> list[tuple[int, int, int]]:
    """(start, end, unit length) of each start's longest repetition of a unit, whatever the unit's length."""
    return [(i, i + (b - i) // p * p, p) for a, b, p in runs(s) for i in range(a, b - 2 * p + 1)]


def brute_cost(c: str) -> float:
    return 1.0 if c.isascii() else 2.0


@lru_cache(20_000)
def guess_cost(s: str) -> tuple[float, str]:
    """(decades of guesses, the cheapest segmentation's kinds and lengths) of a string; (0, "") if empty.

    Each segment after the first costs log10(2) more, for guessing where it begins. Of equal costs the
    segmentation whose last segment is longest wins, then the kind that sorts first. A walk segment has 40 keys at
    most, all other segments may be of any length.
    """
    n, more = len(s), log10(2)
    spans: dict[int, list[tuple[int, float, str]]] = {}
    for i in range(n):
        for j in range(i + 1, min(n, i + _LONGEST) + 1):
            if (c := word_cost(s[i:j])) is not None:
                spans.setdefault(j, []).append((i, c, "word"))
        if s[i].isdigit():
            for j in range(i + 4, min(n, i + 10) + 1):
                if (c := date_cost(s[i:j])) is not None:
                    spans.setdefault(j, []).append((i, c, "date"))
        j = i + 1
        while j < min(n, i + _LONGEST_WALK) and s[j].lower() in NEAR.get(s[j - 1].lower(), ()):
            j += 1
        for e in range(i + 3, j + 1):
            spans.setdefault(e, []).append((i, walk_cost(s[i:e]), "walk"))
    for i, j, p in repeats(s):
        spans.setdefault(j, []).append((i, guess_cost(s[i : i + p])[0] + log10((j - i) / p), "repeat"))
    # best[j]: cheapest cost of s[:j] with its last segment closed; brute[j]: with an open brute-force span
    best: list[tuple[float, int, str]] = [(0.0, 0, "")]
    brute = [(float("inf"), 0)]
    for j in range(1, n + 1):
        start = best[j - 1][0] + (more if j > 1 else 0.0)
        opened = min((start, -(j - 1)), (brute[j - 1][0], -brute[j - 1][1]))
        brute.append((opened[0] + brute_cost(s[j - 1]), -opened[1]))
        options = [(brute[j][0], brute[j][1], "brute")] + [(best[i][0] + c + (more if i else 0.0), i, kind) for i, c, kind in spans.get(j, ())]
        best.append(min(options, key=lambda o: (round(o[0], 9), o[1], o[2])))
    cuts, j = [], n
    while j:
        cuts.append(f"{best[j][2]}:{j - best[j][1]}")
        j = best[j][1]
    return best[n][0], " ".join(reversed(cuts))


def _bare(value: str) -> str:
    """A value without quotation marks, less the commas, semicolons and unopened brackets behind it."""
    n = len(value)
    surplus = {c: value.count(c) - value.count(o) for c, o in _PAIRS.items()}
    while n and (value[n - 1] in ",;" or surplus.get(value[n - 1], 0) > 0):
        if value[n - 1] in surplus:
            surplus[value[n - 1]] -= 1
        n -= 1
    return value[:n]


def contexts(text: str) -> list[tuple[int, str, str]]:
    """(character offset of the value, credential word, value) of every credential context."""
    found = ((m.start(m.lastgroup), m["key"].lower(), _bare(m["bare"]) if m.lastgroup == "bare" else m[m.lastgroup]) for m in _CONTEXT.finditer(text))
    return [(at, key, value) for at, key, value in found if value]


_OUT = "doc_id long, at int, credential string, value_length int, guesses_log10 double, segments string, is_secret boolean"


def scan_secrets(docs: DataFrame, secret: float = SECRET) -> DataFrame:
    """One row (doc_id, at, credential, value_length, guesses_log10, segments, is_secret) a credential value.

    The value itself is not returned. Texts are scanned whole; null and empty ones have no values, repeated
    rows are reported each, an empty table gives no rows, a null doc_id stays null, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                rows = []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    for at, key, value in contexts(text):
                        cost, cuts = guess_cost(value)
                        rows.append((doc, at, key, len(value), round(cost, 6), cuts, cost >= secret))
                if rows:
                    cols = list(zip(*rows))
                    kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.string(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [x.split()[0] for x in _OUT.split(", ")])

    likely = docs.filter(F.col("text").rlike(_PREFILTER)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return likely.mapInArrow(run, _OUT)
