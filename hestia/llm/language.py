"""Language identification by compression with a dictionary for each language.

A dictionary is raw text of the language. A text is compressed with each one;
the one that gives the smallest result names the language, since text of its
own language finds the most in it. Texts are normalised first: lower case,
letters only, white space as one space. A text whose second best size is within
``MARGIN`` of the best is rejected. Where sizes are within ``TIE``, as for very
short texts, the dictionary that holds more of the text's three-letter pieces
names the language; that changes nothing about the rejection.

The dictionaries are the only thing learned: for each language, a piece of the
texts with the smallest hash in each of ``SAMPLE`` buckets of hashes, up to
``DICTIONARY`` bytes. A piece is ``PIECE`` characters from a place in the text
that its hash tells. That bounds what the driver gets at ``SAMPLE`` pieces a
language, whatever the input's size; more than ``LANGUAGES`` are an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hestia.llm.common import reading, sliced

#: Texts a language, characters from each, bytes of a dictionary, languages at most.
SAMPLE, PIECE, DICTIONARY, LANGUAGES = 256, 2000, 1 << 18, 1000
LEVEL = 9
#: A text is rejected where the second best size is less than this share above the best; sizes within this share (or two bytes) tie.
MARGIN, TIE = 0.005, 0.02
#: Characters compressed at a time; sizes of the pieces of a longer text are added up.
BLOCK = 1 << 20

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


def learn(df: DataFrame, *, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language of the rows with a text and a language.

    Two passes of aggregates that combine before the shuffle: the smallest
    hash of each language and bucket, then the texts with these hashes.
    """
    at = F.pmod(F.xxhash64(text), F.greatest(F.lit(1), F.char_length(text) - PIECE + 1)).cast("int") + 1
    known = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.substring(text, at, F.lit(PIECE)).alias("text"), F.xxhash64(text).alias("h")
    )
    least = known.groupBy("lang", F.pmod("h", F.lit(SAMPLE)).alias("b")).agg(F.min("h").alias("h"))
    rows = least.limit(SAMPLE * LANGUAGES + 1).collect()
    if len(rows) > SAMPLE * LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not rows:
        return {}
    wanted = known.join(F.broadcast(df.sparkSession.createDataFrame(rows, "lang string, b long, h long").drop("b")), ["lang", "h"])
    texts: dict[str, list[str]] = {}
    for r in sorted(wanted.groupBy("lang", "h").agg(F.min("text").alias("text")).collect(), key=lambda r: (r.lang, r.h)):
        texts.setdefault(r.lang, []).append(normalised(r.text))
    share = DICTIONARY // SAMPLE
    out = {}
    for name, found in texts.items():
        # Every text gives its share; what short ones leave is filled from the others.
        rest = " ".join(x[share:] for x in found)
        first = " ".join(x[:share] for x in found)
        out[name] = f"{rest} {first}".encode()[-DICTIONARY:]
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.names = sorted(dictionaries)
        params = z.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False)
        dicts = [z.ZstdCompressionDict(dictionaries[n], dict_type=z.DICT_TYPE_RAWCONTENT) for n in self.names]
        for d in dicts:
            d.precompute_compress(compression_params=params)
        self.compressors = [z.ZstdCompressor(dict_data=d, compression_params=params) for d in dicts]
        self.pieces = [{t[i : i + 3] for i in range(len(t) - 2)} for t in (dictionaries[n].decode("utf-8", "ignore") for n in self.names)]

    def sizes(self, text: str) -> list[int]:
        parts = [text[i : i + BLOCK].encode() for i in range(0, len(text), BLOCK)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); ``und`` without a letter. The score is the share of confidence in 0 to 1."""
        clean = normalised(text or "")
        if not clean or not self.names:
            return "und", 0.0, True
        sizes = self.sizes(clean)
        least = min(sizes)
        margin = (sorted(sizes)[1] - least) / least if len(sizes) > 1 else 1.0
        tied = [i for i, s in enumerate(sizes) if s - least <= max(2, TIE * least)]
        best, confidence = tied[0], margin
        if len(tied) > 1:
            padded = f" {clean} "
            held = [sum(padded[j : j + 3] in self.pieces[i] for j in range(len(padded) - 2)) for i in range(len(sizes))]
            best = max(tied, key=lambda i: (held[i], -sizes[i], -i))
            confidence = max(0.0, (held[best] - max(held[i] for i in tied if i != best)) / (len(padded) - 2))
        return self.names[best], min(1.0, 0.5 + 5 * confidence), margin < MARGIN


def classify(df: DataFrame, dictionaries: dict[str, bytes], *, text: str = "text", keep: list[str], names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``keep`` and the predicted language, its score and whether the margin is too narrow, for every row of ``df``.

    Reads nothing but ``text`` of a row. A null text, or one without a letter,
    is ``und`` with score 0, and rejected; equal texts get equal rows; an
    empty table gives an empty one. Without any dictionary all are ``und``.
    """
    chosen, place = reading(df, keep, text)
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier(dictionaries)  # dropped with the task: the worker may live on for other stages
        for batch in sliced(batches, place):
            rows = [c.predict(t) for t in batch.column(place).to_pylist()]
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *made], names=[*batch.schema.names[:kept], *names])

    a, b, c = names
    fields = StructType([*chosen.schema.fields[:kept], *StructType.fromDDL(f"`{a}` string, `{b}` double, `{c}` boolean").fields])
    return chosen.mapInArrow(run, fields)


def held_out(crc: Column) -> Column:
    """Rows that nothing is learned from; a row without an id is learned from."""
    return F.coalesce(crc % 4 == 2, F.lit(False))
