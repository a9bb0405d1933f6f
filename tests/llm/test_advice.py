"""Cases of a review in which the corpus operators did less than the whole job."""

from __future__ import annotations

import pyarrow as pa
import pytest

from sonorium.llm import op4_secrets as op4
from sonorium.llm import op7_toxicity as op7

PLAIN = op7.Lexicon(list(op7.BASE), [], list(op7.CLEAN))
INSULT = "you idiot, you moron"


def scored(*texts):  # noqa: ANN002, ANN201
    return list(zip(*op7.Scorer(PLAIN).score(pa.array(texts, pa.large_string()))))


# --- toxicity: a passage that is toxic by itself stays so in a document of any length


@pytest.mark.parametrize("before, after", [(0, 0), (200_000, 0), (0, 200_000), (20_000, 20_000)])
def test_long_documents_hide_no_insult(before, after):
    assert scored("fine " * before + INSULT + " fine" * after)[0][3]


def test_scattered_hits_stay_clean_and_dense_ones_toxic():
    one, rest = "a moron came by " + "fine " * op7.WINDOW, " fine" * 2 * op7.WINDOW
    assert [r[3] for r in scored(one * 5, "fine words " * 10_000, one * 3 + INSULT + " " + one)] == [False, False, True]
    inside, outside = ("idiot " + "fine " * (op7.WINDOW - gap) + "moron" + rest for gap in (2, 1))
    assert [r[3] for r in scored(inside, outside)] == [True, False]


def test_whatever_the_length_scaled_bar_found_stays_found():
    text = ("idiot " + "fine " * 1_400) * 20
    n = len(text.split())
    (hits, _, score, toxic) = scored(text)[0]
    assert hits == 20 and score >= max(op7.THRESHOLD, op7.DENSITY * n) and toxic


# --- toxicity: quotations of any length, over lines and paragraphs, nested

LONG = "and so the account of that day went on, word for word. " * 100
HITS = "an idiot and moron too"  # away from the marks: non-ASCII ones count as parts of words


@pytest.mark.parametrize("text", [
    f"“{LONG}{HITS} {LONG}”", f'he read: "{LONG}{HITS} {LONG}" and left', f"„{LONG}{HITS} {LONG}“", f"«{LONG}{HITS}» fin", f"“one line\n{HITS}\nanother” it says", f'"one line\n{HITS}\nanother," it says', f"«one\n\n{HITS}\n\nthree»",
    f"“{LONG}\n\n“{HITS} {LONG}\n\n“the end.” so it ends", f'"{LONG}\n\n"{HITS} {LONG}\n\n"the end." so it ends', f"“so they “shouted” and „muttered“ and {HITS}” it says", f"“a \"b\" c {HITS}”", f"“a stray \" mark {HITS}”", f"(“é😀” 5\" tall) “{HITS}”",
])
def test_long_and_nested_quotations_are_quotations(text):
    hits, quoted, score, toxic = scored(text)[0]
    assert (hits, quoted, score, toxic) == (2, 2, 0.5, False)


@pytest.mark.parametrize("text", [
    f"“{LONG}{HITS}", f'"{LONG}{HITS} {LONG}', f"“never closed here. {HITS}\n\nplain\n\n“a quotation” and", f"“short” {HITS} “short”", f'"short" {HITS} "short"', f'"stray {HITS} then "short" end', f"»{HITS}«", f"”{HITS}“", f'12" {HITS} 5" tall',
])
def test_what_is_not_closed_is_no_quotation(text):
    hits, quoted, score, toxic = scored(text)[0]
    assert (hits, quoted, score, toxic) == (2, 0, 2.0, True)


def test_many_marks_take_linear_time():
    for text in ("“" * 200_000, "“a”" * 100_000, '"a ' * 100_000, "“\"«" * 70_000 + "»”" * 70_000, "\n“" * 100_000 + "”"):
        spans = [m.span() for m in op7._QUOTES.finditer(text)]
        assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


# --- secrets: values are taken whole


def whole_values(text):  # noqa: ANN001, ANN201
    """The values of one-line settings "key = value", one a line, read character by character."""
    out = []
    for line in text.splitlines():
        value = line[min(line.index(c) for c in "=:" if c in line) + 1 :].strip(" ")
        if value[0] in "\"'":
            end = 1
            while value[end] != value[0]:
                end += 2 if value[end] == "\\" else 1
            out.append(value[1:end])
        else:
            out.append(value.split()[0])
    return out


def test_values_are_taken_whole():
    text = "\n".join([
        'password = "Tr0ub4dor,&3xQ9!z"', 'passphrase: "correct-zorb blimp quartz 93"', "pwd = 'aB\"9x!Kq02mN'", "password=K9;x$Qw72!zLpp", 'secret = "a\\"b <9x>;Kq" # "old"', "token: 'it\\'s 9xKq,02'", "api_key=aB\"9x!K'q02mN",
        "token=Zx81<kQ>p,w02mN rest", 'pwd: "  k9 "', "secret=hJ8#kd92LqPz", "token=(aB9)[x]",
    ])
    found = op4.contexts(text)
    assert [v for _, _, v in found] == whole_values(text)
    assert all(text[at : at + len(v)] == v for at, _, v in found)
    assert [op4.guess_cost(v)[0] >= op4.SECRET for _, _, v in found[:4]] == [True] * 4


@pytest.mark.parametrize("text, values", [
    ("{'token': 'a b', \"secret\": \"c,d\"}", ["a b", "c,d"]), ('{"m":"token=abc","n":1}', ["abc"]), ("user=x;password=abc;server=y", ["abc"]), ("password=abc,token=Zx81kQpw02mN;", ["abc", "Zx81kQpw02mN"]),
    ("(see token=abc), [pwd: x]", ["abc", "x"]), ("<b>password: abc</b> <i>token=<hidden></i><br>pwd=ab<br/>", ["abc", "<hidden>", "ab"]), ('s = "password=" + pw + ", token=" + t + ""', []), ('password = "never closed', ["never"]), ('password = "a\nb"', ["a"]), ('password="" pwd = \'\'', []),
])
def test_values_end_where_they_end(text, values):
    assert [v for _, _, v in op4.contexts(text)] == values


def test_values_in_hostile_texts_take_linear_time():
    for text in ('password="' * 50_000, "token='\\" * 50_000, "secret=" + "<a,b;" * 40_000, "pwd=" + "a_b,\"" * 40_000 + " "):
        op4.contexts(text)


@pytest.mark.parametrize("walk, turns", [("ertyuiop[]", 1), ("poiuytre", 1), ("qaz", 1), ("1qaz", 1), ("zaq", 1), ("qwert", 1), ("qwedsa", 3), ("qwq", 2), ("ASDFGH", 1)])
def test_walks_turn_on_the_keyboard(walk, turns):
    assert op4.walk_cost(walk) == op4._walk_guesses(len(walk), turns) + (0.5 if walk.isupper() else 0.0)


def test_a_straight_walk_is_no_secret():
    assert round(op4.walk_cost("ertyuiop[]"), 1) == 3.3 and op4.guess_cost("ertyuiop[]")[0] < op4.SECRET
