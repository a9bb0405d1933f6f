"""Language identification by compression.

Each language has a zstandard raw-content dictionary: text of that language that the compressor may refer back
to. A document is lower-cased and compressed in blocks against every dictionary; the language whose dictionary leaves the
fewest bytes wins, unless another comes within a margin, in which case the document is rejected (no language).
Blocks start afresh, so that a long document can't become its own dictionary.

The dictionaries are filled from a bounded sample of rows that carry a language label: of the ``LANGUAGES`` most frequent
languages, whole texts of ``SAMPLE`` rows at most, the ones with the smallest hashes of their ids. A
text that doesn't fit into what is left of a dictionary's ``DICTIONARY_BYTES`` is left out; none is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .textops import chunks

#: Languages that get a dictionary, labelled rows a language, and the most bytes of a dictionary.
LANGUAGES, SAMPLE, DICTIONARY_BYTES = 64, 200, 112 << 10
#: Least advantage of the best language over the second, as a share of the second's bytes.
MARGIN = 0.01
BLOCK, LEVEL = 4 << 10, 3


def fit_dictionaries(docs: DataFrame, sample: int = SAMPLE, size: int = DICTIONARY_BYTES, languages: int = LANGUAGES) -> dict[str, bytes]:
    """language -> dictionary text, from labelled rows (null or empty lang or text are left out).

    The row whose hash is smallest comes last, nearest to the text; of equal rows one is taken. Of languages of
    equal frequency the first by name are taken. A language none of whose texts fits whole has no dictionary.
    """
    rows = docs.filter("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL AND text <> ''")
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    fit = rows.filter(F.octet_length(F.lower("text")) < size).join(F.broadcast(known), "lang").select("lang", F.col("doc_id").cast("string").alias("id"), F.xxhash64(F.col("doc_id").cast("string")).alias("hash"), F.xxhash64("text").alias("mark"))
    order = Window.partitionBy("lang").orderBy("hash", "id", "mark")
    chosen = fit.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample).groupBy("lang", "id", "mark").agg(F.min("rank").alias("rank"))
    some = docs.select(F.col("lang").alias("lang_"), F.col("doc_id").cast("string").alias("id_"), F.xxhash64("text").alias("mark_"), F.col("text").alias("text_"))
    found = some.join(F.broadcast(chosen), F.expr("lang_ = lang AND id_ <=> id AND mark_ = mark")).select("lang", "rank", "text_").distinct().collect()
    out: dict[str, bytes] = {}
    for lang in sorted({r["lang"] for r in found}):
        left, parts = size, []
        for _, t in sorted((r["rank"], r["text_"].lower().encode()) for r in found if r["lang"] == lang):
            if len(t) < left:
                parts.append(t)
                left -= len(t) + 1
        if parts:
            out[lang] = b"\n".join(reversed(parts))
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], block: int = BLOCK) -> None:
        self.langs, self.block, self.compress = sorted(dictionaries), block, []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False).compress)

    def sizes(self, text: bytes) -> list[int]:
        blocks = [text[i : i + self.block] for i in range(0, len(text), self.block)]
        return [sum(len(c(b)) for b in blocks) for c in self.compress]

    def classify(self, text: bytes, margin: float = MARGIN) -> tuple[str | None, float]:
        """(language or None, the best one's advantage over the second as a share of the second's bytes)."""
        if not text or not self.langs:
            return None, 0.0
        ranked = sorted(zip(self.sizes(text), self.langs))
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        won = 1.0 - ranked[0][0] / ranked[1][0]
        return (ranked[0][1] if won >= margin else None), won


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, language, margin, accepted) of every row of docs.

    Texts are compressed whole, however long. ``language`` is null where the margin is too narrow, the text is null or empty, or there is no dictionary;
    ties between languages are a margin of 0. Rows are judged one by one, so repeated rows agree; an empty
    table gives no rows, a null doc_id stays null, other columns (a lang among them) are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Classifier(dictionaries)
        for batch in batches:
            for b in chunks(batch, "text"):
                found = [machine.classify(t, margin) for t in pc.fill_null(pc.utf8_lower(b.column("text")).cast(pa.binary()), b"").to_pylist()]
                lang = [x[0] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(lang, pa.string()), pa.array([round(x[1], 6) for x in found], pa.float64()), pa.array([x is not None for x in lang])],
                    ["doc_id", "language", "margin", "accepted"],
                )

    todo = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return todo.mapInArrow(run, "doc_id long, language string, margin double, accepted boolean")
