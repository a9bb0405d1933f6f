"""Text: whitespace, escapes, paths, JSON, prompts and the ordered correction rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whitespace as Unicode has it; Spark's trim() only knows the space.
_EDGE = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE, "")


def coerce_text(c: Column) -> Column:
    """Null as empty, everything else as stripped text."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def sanitize_text(c: Column) -> Column:
    """Null as empty, everything else as it is."""
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse_whitespace(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def escape_newlines(c: Column) -> Column:
    """Line breaks of any kind as a backslash and an n, so that a CSV row stays one line."""
    return F.regexp_replace(c, "\r\n|\n|\r", r"\\n")


def escape_braces(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    return F.replace(F.replace(c, F.lit("{"), F.lit("{{")), F.lit("}"), F.lit("}}"))


def system_prompt(template: str, title: Column, description: Column) -> Column:
    """template with {title} and {description} filled in; braces of the values stay doubled."""
    out, rest = [], template
    while rest:
        at = min((i for i in (rest.find("{title}"), rest.find("{description}")) if i >= 0), default=-1)
        if at < 0:
            out.append(F.lit(rest))
            break
        out.append(F.lit(rest[:at]))
        field = "{title}" if rest.startswith("{title}", at) else "{description}"
        out.append(escape_braces(title if field == "{title}" else description))
        rest = rest[at + len(field) :]
    return F.concat(*out) if out else F.lit("")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def numbered(pattern: str, *args: Column) -> Column:
    """Zero-padded names such as clip-%05d; wider numbers are never cut, as lpad would."""
    return F.format_string(pattern, *args)


def _quoted(c: Column) -> Column:
    """A JSON string literal: non-ASCII kept, control characters escaped."""
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def json_payload(fields: dict[str, Column]) -> Column:
    """A JSON object of text fields with a space behind colons and commas; nulls are written as null."""
    parts = [F.concat(_quoted(F.lit(k)), F.lit(": "), F.coalesce(F.when(v.isNotNull(), _quoted(v.cast("string"))), F.lit("null"))) for k, v in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


#: Ordered rewrite rules (Java regex, replacement) for Cantonese transcripts; each sees what the ones before it made.
CANTONESE_RULES: list[tuple[str, str]] = [
    ("俾(?!路支|斯麥|益)", "畀"),
    ("(?<!聯關)[系繫](?!統)", "係"),
    ("噶", "㗎"),
    ("姥爺", "老爺"),
    ("咁(?=[我你佢就樣話係啊呀嘅，。])", "噉"),
    ("(?<![曝晾])曬[衣太衫褲被命嘢相]", "晒"),
    ("(?<=好)翻(?=[去到嚟])", "返"),
    ("嚇([，。！？])", "吓$1"),
    ("(唔該|多謝|返|翻)曬", "$1晒"),
    (r"(?U)<\|\w+\|>", ""),
]


def correct(c: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The text after all rules in order; null as empty. Rules are Java regexes with $1-style replacements."""
    return reduce(lambda acc, rule: F.regexp_replace(acc, rule[0], rule[1]), CANTONESE_RULES if rules is None else rules, F.coalesce(c, F.lit("")))
