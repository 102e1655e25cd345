"""Language identification by compression: the language whose dictionary shortens a text most."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of, text_key

UNKNOWN = "und"
# Bound of the labelled sample: per language at most so many documents, of each so many characters.
SAMPLE_DOCS = 512
SAMPLE_CHARS = 512
# A text is compressed in pieces of so many bytes, so the dictionary counts in all of it.
PIECE = 512
LEVEL = 6
_OTHER = re.compile(r"[\W\d_]+")
# A language must save this share of the size that the runner-up needs, or the answer is rejected.
MARGIN = 0.02


def letters_of(text: str) -> str:
    """The letters of a text in lower case, anything between them as one space."""
    return _OTHER.sub(" ", text.lower())


def dictionaries(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Raw-content dictionaries per language from ``labelled (text, lang)``, the most frequent language first.

    Null texts and languages do not count, and languages of one frequency come in code point order.

    A bounded sample serves: texts are dealt into ``docs`` buckets by hash, and of each bucket and
    language the text with the smallest hash gives ``chars`` characters. Only those reach the driver.
    """
    key = text_key(F.col("text"))
    sample = labelled.filter("lang is not null and text is not null and length(text) > 0").select(
        "lang",
        F.pmod(key["a"], F.lit(docs)).alias("bucket"),
        F.struct(key["b"].alias("h"), F.substring("text", 1, chars).alias("piece")).alias("s"),
    )
    rows = sample.groupBy("lang", "bucket").agg(F.min("s").alias("s")).select("lang", "bucket", "s.piece").collect()
    pieces: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["bucket"])):
        pieces.setdefault(row["lang"], []).append(row["piece"])
    counted = labelled.filter("lang is not null and text is not null and length(text) > 0").groupBy("lang").count().collect()
    ranked = [r["lang"] for r in sorted(counted, key=lambda r: (-r["count"], r["lang"]))]
    return {lang: letters_of("\n".join(pieces[lang])).encode() for lang in ranked}


class Classifier:
    """Compressors of all languages; the sizes of a text's pieces add up."""

    def __init__(self, contents: dict[str, bytes], level: int = LEVEL):
        self.languages = list(contents)
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, text: str, piece: int = PIECE) -> list[int]:
        data = letters_of(text).encode()
        pieces = [data[i : i + piece] for i in range(0, len(data), piece)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, score, rejected)``; the score is the share saved against the runner-up, 1 for a language alone.

        Equal sizes go to the first of those languages, with score 0. A text that is null or
        has no letter, or a model without languages, gives ``und`` with score 0.
        """
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        ranked = sorted(zip(self.sizes(text), range(len(self.languages))))
        (least, best), second = ranked[0], ranked[1][0] if len(ranked) > 1 else None
        score = 1.0 if second is None else 1.0 - least / second
        return self.languages[best], score, score < MARGIN


def identified(docs: DataFrame, contents: dict[str, bytes], level: int = LEVEL) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` per row of ``docs (doc_id, text, …)``, from the whole text alone.

    ``rejected`` marks answers with a margin below :data:`MARGIN`; they still name the nearest language.
    """

    def classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(contents, level)
        for batch in pieces_of(batches, "text"):
            found = [model.classify(text.as_py()) for text in batch["text"]]
            langs, scores, rejected = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        classified, "doc_id bigint, lang_pred string, score double, rejected boolean"
    )


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
