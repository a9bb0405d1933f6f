"""Secrets, URLs, toxicity, BPE and language ID against brute force, other implementations or held-out rows."""

from __future__ import annotations

import fnmatch
import random
import re
from itertools import combinations
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from sonorium.llm import op4_secrets as op4
from sonorium.llm import op6_urls as op6
from sonorium.llm import op7_toxicity as op7
from sonorium.llm import op8_bpe as op8
from sonorium.llm import op9_langid as op9

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, tokens int"


def table(spark, rows):  # noqa: ANN001, ANN201
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], SCHEMA).repartition(3)


# --- secrets


def brute_cost(s: str) -> float:
    """Minimum over all segmentations and all kinds of every segment."""
    best = 1e9
    for k in range(len(s)):
        for cuts in combinations(range(1, len(s)), k):
            edges = [0, *cuts, len(s)]
            total = k * log10(2)
            for a, b in zip(edges, edges[1:]):
                x = s[a:b]
                kinds = [sum(map(op4.brute_cost, x)), op4.word_cost(x), op4.date_cost(x), op4.walk_cost(x)]
                for p in range(1, len(x) // 2 + 1):
                    if len(x) % p == 0 and x == x[:p] * (len(x) // p):
                        kinds.append(op4.guess_cost(x[:p])[0] + log10(len(x) / p))
                total += min(c for c in kinds if c is not None)
            best = min(best, total)
    return best


@pytest.mark.parametrize("s", ["password1", "qwerty12", "abcabcabc", "1999-12-31", "x7Kq9", "P@ssw0rd", "drowssap", "zzzzzz", "ünï", "asdf2001", "a"])
def test_guess_cost_is_the_cheapest_segmentation(s):
    assert abs(op4.guess_cost(s)[0] - brute_cost(s)) < 1e-6


def test_guess_cost_of_random_strings():
    rnd = random.Random(2)
    for _ in range(60):
        s = "".join(rnd.choice("aqw12s0") for _ in range(rnd.randrange(1, 10)))
        assert abs(op4.guess_cost(s)[0] - brute_cost(s)) < 1e-6
    assert op4.guess_cost("") == (0.0, "")


def test_guess_cost_of_very_long_values():
    assert op4.guess_cost("qw" * 5000)[0] < 20
    rnd = random.Random(1)
    assert op4.guess_cost("".join(rnd.choice("abcdefXYZ0189") for _ in range(20_000)))[0] > 1000


def test_secrets(spark):
    rows = [(1, "db password = hJ8#kd92LqPz and token: changeme"), (2, None), (3, ""), (None, 'API_KEY="9f8e7d6c5b4a39281706"'), (1, "db password = hJ8#kd92LqPz and token: changeme"), (4, "x " * 200_000 + "secret=Zx81kQpw02mN"), (5, "the password is safe")]
    docs = table(spark, rows)
    got = sorted(((r["doc_id"], r["credential"], r["is_secret"]) for r in op4.scan_secrets(docs).collect()), key=repr)
    want = [(1, "password", True), (1, "token", False)] * 2 + [(None, "api_key", True), (4, "secret", True)]
    assert got == sorted(want, key=repr)
    assert op4.scan_secrets(docs.limit(0)).count() == 0


def test_secret_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r["doc_id"], at, key, len(v), round(op4.guess_cost(v)[0], 6), op4.guess_cost(v)[0] >= op4.SECRET) for r in docs if r["text"] for at, key, v in op4.contexts(r["text"]))
    got = op4.scan_secrets(spark.read.parquet(f"{SF}/documents.parquet"))
    assert sorted(map(tuple, got.select("doc_id", "at", "credential", "value_length", "guesses_log10", "is_secret").collect())) == want


# --- URLs


def test_globs_equal_fnmatch():
    globs = [g for g in op6.RULES.values() if "[" not in g] + ["*", "?", "", "a*b?c", "**x"]
    rnd = random.Random(4)
    urls = ["".join(rnd.choice("abc./:x?") for _ in range(rnd.randrange(0, 14))) for _ in range(300)] + ["https://spam-farm.example.org/x.exe", "ftp://a/" + "b" * 5000 + ".zip", "http://a/é😀?page=12"]
    got = op6.GlobSet(globs).match(urls)
    for u, hit in zip(urls, got):
        assert hit == [i for i, g in enumerate(globs) if re.fullmatch(fnmatch.translate(g), u)], u


def test_url_filter(spark):
    rows = [(1, " HTTPS://www.Spam-Farm.com:443/a/#x "), (2, None), (None, ""), (3, "http://u@h.org/p/?b=2&utm_source=q&a=1&&ref"), (3, "http://u@h.org/p/?b=2&utm_source=q&a=1&&ref"), (4, "no scheme#f"), (5, "http://a/" + "z" * 30_000 + ".pdf")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, rules string")
    got = {(r["page_id"], r["canonical_url"]): (r["rules"], r["blocked"]) for r in op6.filter_urls(pages).collect()}
    assert got[1, "https://spam-farm.com/a"] == (["spam:spam-farm"], True)
    assert got[2, None] == ([], False) and got[None, ""] == ([], False) and (3, "http://h.org/p?a=1&b=2") in got and (4, "no scheme") in got
    assert op6.filter_urls(pages).count() == 7 and op6.filter_urls(pages.limit(0)).count() == 0
    assert op6.filter_urls(pages, {}).filter("blocked").count() == 0


# --- toxicity


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ["scum", "idiot", "moron", "worthless", "imbecile", "idiots"]
    machine = op7.Automaton(op7.Lexicon(terms, ["vermin"], ["idiom"]))
    rnd = random.Random(7)
    probes = list(terms)
    for t in terms * 120:
        x = list(t)
        for _ in range(rnd.randrange(0, 4)):
            k = rnd.randrange(3)
            at = rnd.randrange(len(x) + 1)
            if k == 0:
                x.insert(at, rnd.choice("abeiost"))
            elif x and k == 1:
                x.pop(min(at, len(x) - 1))
            elif x:
                x[min(at, len(x) - 1)] = rnd.choice("abeiost")
        probes.append("".join(x))
    for w in [*probes, "vermin", "vermins", "verm", "idiom", ""]:
        near = min(((d, t) for t in terms if (d := distance(w, t)) <= op7.tolerance(t)), default=None)
        want = (near[1], 0) if near and near[0] == 0 else ("vermin*", 0) if w.startswith("vermin") else None if near is None or w == "idiom" else (near[1], near[0])
        assert machine.look(w) == want, w


def test_context_and_awkward_rows(spark):
    lex = op7.Lexicon(list(op7.BASE), [], list(op7.CLEAN))
    insult, quoted = "you idiot, you moron", 'he said "idiot" and "moron"'
    rows = [(1, insult), (2, quoted), (3, None), (4, ""), (None, insult), (1, insult), (5, "fine words " * 100_000), (6, "you idi0t you morron"), (7, "fine " * 200_000 + insult)]
    docs = table(spark, rows)
    got = {r["doc_id"]: r for r in op7.score_toxicity(docs, lex).collect()}
    assert got[1]["toxic"] and got[None]["toxic"] and got[6]["toxic"]
    assert not got[2]["toxic"] and got[2]["n_quoted"] == 2 and got[2]["score"] < got[1]["score"]
    assert got[7]["toxic"] and not any(got[i]["toxic"] for i in (3, 4, 5)) and got[3]["score"] == 0
    kept = op7.drop_toxic(docs, lex)
    assert kept.columns == docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == [2, 3, 4, 5]
    assert op7.score_toxicity(docs.limit(0), lex).count() == 0 and op7.drop_toxic(docs.limit(0), lex).count() == 0


def test_scorer_equals_plain_loop(spark):
    lex = op7.fit_lexicon(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    machine = op7.Automaton(lex)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    hits, _, score, toxic = op7.Scorer(lex).score(pa.array(texts, pa.large_string()))
    for t, h, s, bad in zip(texts, hits, score, toxic):
        low = t.lower()
        spans = [m.span() for m in op7._QUOTES.finditer(low)]
        found = [(m.start(), m.group()) for m in re.finditer(r"[0-9a-z\x80-\U0010ffff]+", low)]
        tokens = [w for _, w in found]
        mine = [(i, f[1], any(a <= at < b for a, b in spans)) for i, (at, w) in enumerate(found) if (f := machine.look(w))]
        total = round(op7.judge(tokens, mine)[0], 6)
        assert (h, s, bad) == (len(mine), total, total >= max(op7.THRESHOLD, op7.DENSITY * len(tokens)) and bool(tokens))


def test_toxicity_on_labels(spark):
    """Two folds, each judged by a lexicon that the other one taught."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.filter("toxic IS NOT NULL").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    right = total = caught = bad = 0
    for fold in (0, 1):
        lex = op7.fit_lexicon(docs, known.filter(F.col("fold") != fold).drop("fold"))
        for r in op7.score_toxicity(docs, lex).join(known.filter(F.col("fold") == fold).select("doc_id", F.col("toxic").alias("is")), "doc_id").collect():
            total, right = total + 1, right + (r["toxic"] == bool(r["is"]))
            bad, caught = bad + r["is"], caught + (r["is"] and r["toxic"])
    assert right / total >= 0.95, (right, total, caught, bad)
    assert caught / max(bad, 1) >= 0.8, (caught, bad)


def test_lexicon_without_labels(spark):
    docs = table(spark, [(1, "a")])
    none = spark.createDataFrame([(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    assert op7.fit_lexicon(docs, None).terms == list(op7.BASE) == op7.fit_lexicon(docs, none).terms == op7.fit_lexicon(docs.limit(0), none).terms


# --- BPE

PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ODD = ["", "Hello  world's   \n\n we'll've 'tis '' 's x's", "a" * 3000, "   ", "日本語テキスト 12３ ½ é́", "\t\n x \r\n", "don'T I'LL 're 'r 'l 'll", "emoji 😀😀   x", "'", " '", "'s's's", "x'", "\x00\x1f", "12 345 6.78,9"]


@pytest.fixture(scope="module")
def reference():  # noqa: ANN201
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=op8.read_ranks(), special_tokens={})


def pairs_of(texts, machine):  # noqa: ANN001, ANN201
    tokens, bound, ends, _, _ = machine.encode(pa.array(texts, pa.string()))
    return [(tokens[a:b].tolist(), ends[a:b].tolist()) for a, b in zip(bound[:-1], bound[1:])]


def test_tokens_equal_tiktoken(spark, reference):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    rnd = random.Random(3)
    texts += ["".join(rnd.choice(" 'sltvedr\n\tA1é.日") for _ in range(rnd.randrange(40))) for _ in range(1500)]
    machine = op8.Codec(op8.read_ranks())
    for t, (tokens, ends) in zip(texts, pairs_of(texts, machine)):
        assert tokens == reference.encode_ordinary(t), t[:80]
        assert (ends[-1] if ends else 0) == len(t.encode())
        assert machine.decode(np.array(tokens, np.int64)).tobytes() == t.encode()


def test_offsets_cut_the_bytes(reference):
    machine = op8.Codec(op8.read_ranks())
    for t, (tokens, ends) in zip(ODD, pairs_of(ODD, machine)):
        starts = [0, *ends[:-1]]
        assert [t.encode()[a:b] for a, b in zip(starts, ends)] == [reference.decode_single_token_bytes(x) for x in tokens]


def test_encode_and_decode_frames(spark):
    rows = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "née"), (4, "word " * 300_000)]
    docs = table(spark, rows)
    coded = op8.encode(docs)
    got = {r["doc_id"]: r for r in coded.collect()}
    assert got[2]["tokens"] == [] and got[2]["round_trip"] is None and got[3]["round_trip"] is True and got[4]["n_tokens"] >= 300_000
    assert coded.filter("NOT round_trip").count() == 0 and coded.count() == 6
    back = sorted(((r["doc_id"], r["text"]) for r in op8.decode(coded).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t in rows), key=repr)
    assert op8.encode(docs.limit(0)).count() == 0 and op8.decode(coded.limit(0)).count() == 0


# --- language ID


def test_language_accuracy_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    dictionaries = op9.fit_dictionaries(docs.filter("fold = 0"))
    rows = op9.identify(docs.filter("fold = 1"), dictionaries).join(docs.select("doc_id", F.col("lang").alias("is"), F.length("text").alias("n")), "doc_id").filter("is IS NOT NULL AND n >= 100").collect()
    accepted = [r for r in rows if r["accepted"]]
    assert len(accepted) / len(rows) > 0.85, (len(accepted), len(rows))
    assert sum(r["language"] == r["is"] for r in accepted) / len(accepted) > 0.95


def test_language_awkward_rows(spark):
    english, french = "the quick brown fox jumps over the lazy dog " * 20, "le renard brun saute par dessus le chien " * 20
    machine = op9.Classifier({"en": english.encode(), "fr": french.encode()})
    assert machine.classify(b"the lazy dog jumps over the fox")[0] == "en" and machine.classify(b"le chien brun saute")[0] == "fr"
    assert machine.classify(b"")[0] is None and op9.Classifier({}).classify(b"x") == (None, 0.0)
    assert machine.classify(b"\xf0\x9f\x98\x80")[0] is None
    docs = table(spark, [(1, english), (2, None), (3, ""), (None, french), (4, english * 200), (1, english)])
    got = op9.identify(docs, {"en": english.encode(), "fr": french.encode()})
    by = {r["doc_id"]: r["language"] for r in got.collect()}
    assert by == {1: "en", 2: None, 3: None, None: "fr", 4: "en"} and got.count() == 6
    assert op9.identify(docs.limit(0), {}).count() == 0 and op9.fit_dictionaries(docs.limit(0)) == {}
