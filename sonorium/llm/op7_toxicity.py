"""Toxicity by Levenshtein automata intersected with a lexicon trie, scored in context.

The lexicon is a trie of insults, each with the number of edits it tolerates, and of stems that any ending
may follow. The Levenshtein automaton runs over the whole trie at once: a state is the set of (trie node,
edits so far) that a prefix of the word can have reached, and states are interned as they first
appear, so a word costs one dictionary step a character and nearly all die after a few. Distinct words are
judged once per batch and worker.

A small built-in lexicon is completed from labelled rows: words and stems that keep to toxic documents and
stand in many different contexts there (copies of one toxic text repeat its contexts and teach nothing).
The sample of labelled rows is bounded by ``SAMPLE``; the documents that are then judged are all of them.

A hit weighs less for each edit, much less inside quotation marks, less after a reporting word (said, wrote
...), and more beside a word of address (you ...). A document is toxic if any ``WINDOW`` words in a row weigh
``THRESHOLD``, however long the rest is; or if it weighs ``THRESHOLD`` as a whole and ``DENSITY`` a word.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructType

from .common import cut, fresh, released
from .textops import buffer, chunks, word_hashes, words

#: Labelled rows the lexicon is fitted on, those with the smallest hashes of doc_id.
SAMPLE = 20_000
THRESHOLD, DENSITY = 1.5, 0.0005
#: Words in which the hits that make a document toxic stand together; a document of no more is judged as a whole.
WINDOW = round(THRESHOLD / DENSITY)
EDIT_WEIGHT = (1.0, 0.6, 0.4)
QUOTED, REPORTED, ADDRESSED = 0.25, 0.5, 1.25
#: Words before a hit in which a reporting word counts, and on both sides a word of address.
REPORT_SPAN, ADDRESS_SPAN = 4, 3
#: A term is learnt from MIN_DOCS toxic documents and as many different contexts, in MIN_FRESH of its occurrences at
#: least, and if not more than IMPURE of the documents with it are clean (in rates).
MIN_DOCS, MIN_FRESH, IMPURE = 8, 0.35, 0.02
#: Characters of the shortest and the longest stem that is learnt.
STEM, STEM_MOST = 4, 12

BASE = (
    "idiot idiots moron morons imbecile stupid scum scumbag loser losers pathetic worthless trash clown disgusting bastard bitch asshole "
    "dumbass retard retarded degenerate vermin subhuman parasite filth whore slut cunt wanker dickhead fuck fucker fucking motherfucker shithead bullshit"
).split()
#: Ordinary words an edit away from a term.
CLEAN = (
    "where whole whose shore chore whores loose lose loser's closer lower poser loses crown blown brown clowns crash brash thrash track trays fifth faith births filch "
    "bitte batch pitch witch ditch birch butch slit slot shut count cunning custard mustard dastard studio retire retail reward regard ducking sucking tucking buck duck luck muck suck tuck "
    "scam scan swum serum parasites empathetic apathetic sympathetic boron baron macron mormon disgustingly idiom idiotic limbo pathetically"
).split()
REPORTING = set("said says wrote writes called calls quoted quote quotes claimed alleged reported tweeted dit disait écrit sagte schrieb nannte dijo llamó escribió".split())
ADDRESS = set("you your you're youre yourself u ur tu te toi ton vous votre du dich dir dein ihr euch eres usted tú ti".split())
_MARK = re.compile("[“”„«»\"]|\n[ \t\r]*\n")
#: White space before the first mark of a line.
_INDENT = 64
_CLOSES = {"”": ("“", "„"), "“": ("„",), "»": ("«",)}


class Span(NamedTuple):
    a: int
    b: int

    def span(self) -> tuple[int, int]:
        return self.a, self.b


class Quotations:
    """Outermost quotations of a text, of any length, paired in one pass over its marks.

    A mark closes the last open one of its kind, and what was opened since and never closed falls away. Straight
    marks open behind white space or a bracket and close before white space or punctuation; one that can only open
    gives up the straight one before it. A mark that opens a line of the same or the next paragraph, while
    its kind is open, carries the quotation on. What is never closed is no quotation.
    """

    def finditer(self, text: str) -> Iterator[Span]:
        stack: list[list] = []  # kind, start, paragraph
        count: Counter[str] = Counter()
        done: list[Span] = []
        paragraph = 0
        for m in _MARK.finditer(text):
            c, at = m.group(), m.start()
            if c[0] == "\n":
                paragraph += 1
                continue
            if c == '"':
                opens = at == 0 or text[at - 1].isspace() or text[at - 1] in "([“„«"
                closes = at + 1 == len(text) or text[at + 1].isspace() or text[at + 1] in ".,;:!?)]”“»"
                closed = (c,) if closes and count[c] else ()
            else:
                opens, closed = c in "“„«", tuple(k for k in _CLOSES.get(c, ()) if count[k])
            if closed:
                while True:
                    kind, start, _ = stack.pop()
                    count[kind] -= 1
                    if kind in closed:
                        break
                while done and done[-1].a >= start:
                    done.pop()
                done.append(Span(start, m.end()))
            elif opens:
                before = text[max(0, at - _INDENT) : at].rstrip(" \t")
                first = before[-1:] == "\n"
                if stack and stack[-1][0] == c and first and stack[-1][2] >= paragraph - 1:
                    stack[-1][2] = paragraph
                    continue
                if c == '"' and stack and stack[-1][0] == c:
                    stack[-1][1:] = [at, paragraph]
                    continue
                stack.append([c, at, paragraph])
                count[c] += 1
        yield from done


_QUOTES = Quotations()


def quoted_bytes(text: str) -> list[tuple[int, int]]:
    """Start and end of each outermost quotation, in bytes of UTF-8."""
    out, at, size = [], 0, 0
    for m in _QUOTES.finditer(text):
        a = size + len(text[at : m.a].encode())
        at, size = m.b, a + len(text[m.a : m.b].encode())
        out.append((a, size))
    return out


def tolerance(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass
class Lexicon:
    """terms tolerate edits, stems must stand as they are at a word's start, clean words never hit by edits."""

    terms: list[str]
    stems: list[str] = field(default_factory=list)
    clean: list[str] = field(default_factory=list)


class Automaton:
    """The lazily determinised intersection of the Levenshtein automaton with a lexicon's trie."""

    DEAD = 0

    def __init__(self, lexicon: Lexicon) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.reach = [-1]  # the most edits that any term at or below the node tolerates; -1: only stems are there
        for t in sorted(set(lexicon.terms)):
            for n in self._add(t):
                self.reach[n] = max(self.reach[n], tolerance(t))
            self.term[n] = t
        for t in sorted(set(lexicon.stems)):
            self.stem[self._add(t)[-1]] = t
        self.clean = frozenset(lexicon.clean)
        self.states: dict[tuple, int] = {(): 0}
        self.step: list[dict[str, int]] = [{}]
        self.sets: list[tuple] = [()]
        self.start = self._state({0: 0}, None)

    def _add(self, word: str) -> list[int]:
        at, path = 0, [0]
        for c in word:
            if c not in self.child[at]:
                self.child[at][c] = len(self.child)
                self.child.append({})
                self.term.append(None)
                self.stem.append(None)
                self.reach.append(-1)
            at = self.child[at][c]
            path.append(at)
        return path

    def _state(self, reached: dict[int, int], stem: str | None) -> int:
        todo = list(reached.items())
        while todo:  # a character of the lexicon left out
            n, e = todo.pop()
            for m in self.child[n].values():
                if e + 1 <= self.reach[m] and reached.get(m, 99) > e + 1:
                    reached[m] = e + 1
                    todo.append((m, e + 1))
        key = (stem, *sorted(reached.items())) if reached or stem else ()
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
        return self.states[key]

    def _next(self, state: int, c: str) -> int:
        stem, *reached = self.sets[state]
        new: dict[int, int] = {}

        def reach(n: int, e: int) -> None:
            if e < new.get(n, 99):
                new[n] = e

        for n, e in reached:
            m = self.child[n].get(c)
            if m is not None and e <= max(self.reach[m], 0):
                reach(m, e)
                if e == 0 and stem is None:
                    stem = self.stem[m]
            if e + 1 <= self.reach[n]:
                reach(n, e + 1)
            for m in self.child[n].values():
                if e + 1 <= self.reach[m]:
                    reach(m, e + 1)
        to = self._state(new, stem)
        self.step[state][c] = to
        return to

    def look(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, the first in order of ties; a stem counts as no edits."""
        s = self.start
        for c in word:
            to = self.step[s].get(c)
            s = self._next(s, c) if to is None else to
            if s == self.DEAD:
                return None
        stem, *reached = self.sets[s]
        best = min(((e, self.term[n]) for n, e in reached if self.term[n] is not None and e <= tolerance(self.term[n])), default=None)
        if best is not None and best[0] == 0:
            return best[1], 0
        if stem is not None:
            return stem + "*", 0
        if best is None or word in self.clean:
            return None
        return best[1], best[0]


def weights(tokens: list[str], hits: list[tuple[int, int, bool]]) -> list[float]:
    """The weight of each of a document's (word number, edits, in quotation marks) hits."""
    out = []
    for i, edits, inside in hits:
        w = EDIT_WEIGHT[edits]
        if inside:
            w *= QUOTED
        elif any(t in REPORTING for t in tokens[max(0, i - REPORT_SPAN) : i]):
            w *= REPORTED
        if any(t in ADDRESS for t in tokens[max(0, i - ADDRESS_SPAN) : i + ADDRESS_SPAN + 1]):
            w *= ADDRESSED
        out.append(w)
    return out


def judge(tokens: list[str], hits: list[tuple[int, int, bool]]) -> tuple[float, int]:
    """(weight, hits in quotation) of a document's (word number, edits, in quotation marks) hits."""
    return sum(weights(tokens, hits)), sum(inside for _, _, inside in hits)


def densest(at: list[int], weight: list[float]) -> float:
    """The most that the hits at ascending word numbers weigh within WINDOW words."""
    best = now = 0.0
    first = 0
    for i, w in zip(at, weight):
        now += w
        while at[first] <= i - WINDOW:
            now -= weight[first]
            first += 1
        best = max(best, now)
    return best


def verdict(at: list[int], weight: list[float], n_words: int) -> bool:
    """Whether hits at ascending word numbers make a document of n_words toxic."""
    total = round(sum(weight), 6)
    return total >= THRESHOLD and (total >= DENSITY * n_words or round(densest(at, weight), 6) >= THRESHOLD)


class Scorer:
    """Scores batches of texts; remembers the words it has judged, up to KNOWN of them."""

    KNOWN = 300_000

    def __init__(self, lexicon: Lexicon) -> None:
        self.machine = Automaton(lexicon)
        self.known: dict[int, int] = {}  # hash of a word -> edits of its hit, or -1

    def hits(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that hit, and their edits."""
        distinct, first, which = np.unique(word_hashes(buf, start, end), return_index=True, return_inverse=True)
        if len(self.known) > self.KNOWN:
            self.known.clear()
        known, look = self.known, self.machine.look
        verdict = np.empty(len(distinct), np.int8)
        s, e = start[first].tolist(), end[first].tolist()
        raw = buf.tobytes()
        for k, h in enumerate(distinct.tolist()):
            v = known.get(h)
            if v is None:
                found = look(raw[s[k] : e[k]].decode("utf-8", "replace"))
                v = known[h] = -1 if found is None else found[1]
            verdict[k] = v
        at = np.flatnonzero((verdict >= 0)[which])
        return at, verdict[which[at]]

    def score(self, texts: pa.Array) -> tuple[list[int], list[int], list[float], list[bool]]:
        """(hits, quoted hits, score, toxic) of each text."""
        n = len(texts)
        out_hits, out_quoted, out_score, out_toxic = [0] * n, [0] * n, [0.0] * n, [False] * n
        buf, offsets = buffer(pc.utf8_lower(texts))
        start, end, first = words(buf, offsets)
        if not len(start):
            return out_hits, out_quoted, out_score, out_toxic
        at, edits = self.hits(buf, start, end)
        owner = np.searchsorted(first, at, "right") - 1
        docs, cuts = np.unique(owner, return_index=True)  # hits come in the order of the texts
        for d, mine in zip(docs.tolist(), map(slice, cuts.tolist(), [*cuts[1:].tolist(), len(owner)])):
            a, b, o = int(first[d]), int(first[d + 1]), int(offsets[d])
            raw = buf[o : int(offsets[d + 1])].tobytes()
            text = raw.decode("utf-8", "replace")
            spans = quoted_bytes(text) if any(q in text for q in '"“„«') else []
            opening = [x for x, _ in spans]
            rel_start = (start[a:b] - o).tolist()
            rel_end = (end[a:b] - o).tolist()
            local = [(int(i) - a, int(x)) for i, x in zip(at[mine], edits[mine])]
            near = {j for i, _ in local for j in range(max(0, i - REPORT_SPAN), min(b - a, i + ADDRESS_SPAN + 1))}
            tokens = [""] * (b - a)
            for j in near:
                tokens[j] = raw[rel_start[j] : rel_end[j]].decode("utf-8", "replace")
            found = [(i, x, (k := bisect_right(opening, rel_start[i])) > 0 and rel_start[i] < spans[k - 1][1]) for i, x in local]
            weight = weights(tokens, found)
            out_hits[d], out_quoted[d], out_score[d] = len(local), sum(inside for _, _, inside in found), round(sum(weight), 6)
            out_toxic[d] = verdict([i for i, _ in local], weight, b - a)
        return out_hits, out_quoted, out_score, out_toxic


def _prefixes(word: str) -> Iterable[str]:
    return (word[:k] + "*" for k in range(STEM, min(len(word), STEM_MOST) + 1))


def _tokens(texts: pa.Array) -> Iterator[list[str]]:
    buf, offsets = buffer(pc.utf8_lower(texts))
    start, end, first = words(buf, offsets)
    raw, s, e = buf.tobytes(), start.tolist(), end.tolist()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        yield [raw[s[i] : e[i]].decode("utf-8", "replace") for i in range(a, b)]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for b in chunks(batch, "text"):
            for bad, tokens in zip(b.column("toxic").to_pylist(), _tokens(b.column("text"))):
                seen = set(tokens)
                seen |= {p for w in seen for p in _prefixes(w)}
                (toxic if bad else clean).update(seen)
    for bad, counts in ((True, toxic), (False, clean)):
        while counts:
            some = [counts.popitem() for _ in range(min(20_000, len(counts)))]
            n, none = pa.array([k for _, k in some], pa.int64()), pa.array([0] * len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in some], pa.string()), n if bad else none, none if bad else n], ["term", "bad", "good"])


def _stems(n: dict[str, int]) -> list[str]:
    """Stems of families of words: no single word makes up a third of what begins with them.

    Of stems in one another the shortest is taken, then lengthened while it loses no more than a twentieth.
    """
    most: Counter[str] = Counter()
    for w, k in n.items():
        if not w.endswith("*"):
            for p in _prefixes(w):
                most[p] = max(most[p], k)
    able = {t[:-1]: k for t, k in n.items() if t.endswith("*") and k >= 3 * most[t]}
    out: list[str] = []
    for t in sorted(able, key=lambda t: (len(t), t)):
        if not t.startswith(tuple(out)):
            out.append(max((x for x in able if x.startswith(t) and able[x] >= 0.95 * able[t]), key=lambda x: (len(x), x)))
    return sorted(set(out))


def fit_lexicon(docs: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> Lexicon:
    """The built-in terms, with those that a bounded sample of labelled documents teaches.

    Rows of labels with a null doc_id or toxic are not used; without labels, the built-in terms are all.
    """
    base = Lexicon(list(BASE), [], list(CLEAN))
    if labels is None:
        return base
    chosen = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), (F.col("toxic") != 0).alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.filter("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    found = cut(texts.join(F.broadcast(chosen.groupBy("id").agg(F.max("toxic").alias("toxic"))), "id"), "labelled")
    size = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_bad, n_good = size.get(True, 0), size.get(False, 0)
    if not n_bad or not n_good:
        return base
    counts = found.mapInArrow(released(_document_counts), "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    pure = counts.filter((F.col("bad") >= MIN_DOCS) & (F.col("good") / n_good <= IMPURE * F.col("bad") / n_bad)).collect()
    if not pure:
        return base
    wanted = {r["term"]: r["bad"] for r in pure}

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, around = [], []
        for batch in batches:
            for b in chunks(batch, "text"):
                for tokens in _tokens(b.column("text")):
                    for i, w in enumerate(tokens):
                        mine = [t for t in (w, *_prefixes(w)) if t in wanted]
                        if mine:
                            terms += mine
                            around += [" ".join(tokens[max(0, i - 2) : i] + ["_"] + tokens[i + 1 : i + 3])] * len(mine)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(around, pa.string())], ["term", "around"])

    seen = found.filter("toxic").mapInArrow(released(contexts), "term string, around string")
    rows = seen.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct("around").alias("fresh")).collect()
    good = {r["term"]: r["fresh"] for r in rows if r["fresh"] >= MIN_DOCS and r["fresh"] >= MIN_FRESH * r["n"]}
    stems = _stems({r["term"]: r["n"] for r in rows if r["term"] in good})
    learnt = Lexicon(sorted({*BASE, *(t for t in good if not t.endswith("*") and not t.startswith(tuple(stems)))}), stems, list(CLEAN))

    def harmless(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, out = Automaton(learnt), set()
        for batch in batches:
            for b in chunks(batch, "text"):
                for tokens in _tokens(b.column("text")):
                    out |= {w for w in set(tokens) if (f := machine.look(w)) and f[1]}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.string())], ["term"])

    learnt.clean += sorted(r["term"] for r in found.filter("NOT toxic").mapInArrow(released(harmless), "term string").distinct().collect())
    return learnt


def _score(docs: DataFrame, lexicon: Lexicon, out: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            for b in chunks(batch, "text"):
                h, q, s, t = scorer.score(b.column("text").cast(pa.large_string()))
                cols = [pa.array(h, pa.int32()), pa.array(q, pa.int32()), pa.array(s, pa.float64()), pa.array(t, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *out])

    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(out, (IntegerType(), IntegerType(), DoubleType(), BooleanType())):
        schema = schema.add(name, kind)
    return docs.mapInArrow(released(run), schema)


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, n_hits, n_quoted, score, toxic) of every row of docs.

    Null and empty texts score 0 and are not toxic, very long ones are read whole. Rows are judged one by one, so repeated rows agree;
    an empty table gives no rows, a null doc_id stays null, other columns are ignored.
    """
    todo = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _score(todo, lexicon, ["n_hits", "n_quoted", "score", "toxic"]).drop("text")


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """docs without the toxic rows, all columns kept as they are: null and empty texts, repeated rows, rows without doc_id."""
    names = [fresh(docs, n) for n in ("tox_hits", "tox_quoted", "tox_score", "tox_verdict")]
    return _score(docs, lexicon, names).filter(~F.col(names[3])).drop(*names)
