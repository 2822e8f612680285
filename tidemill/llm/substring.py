"""Substring dedup by hashing units of lines: runs of units that stand earlier go, the first place of each stays."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.shared import dropped, in_batches, named, plain_names, row_keys, stored, with_keys

#: Every character of a text is in exactly one unit: a line end, or a stretch of a line up to its full stops.
UNIT = r"\n|[^.!?\n]+[.!?]*|[.!?]+"
LINE = r"\n|[^\n]+"
#: Least words of a run of repeated units that goes.
RUN_WORDS = 4
#: The same where single sentences and short lines shall stay and only passages go.
PASSAGE_WORDS = 25
#: So many characters count as a word at least, for scripts without spaces.
WORD_CHARS = 8
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPACE = " \t\r\n\f\v"


def normalised(unit: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(unit), r"[ \t\r\n\f\u000B]+", " "))


def _units(docs: DataFrame, pattern: str) -> DataFrame:
    """(key, pos, words, digest) of every unit that is not blank, of texts with their ``_key``."""
    parts = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    sized = docs.where("text IS NOT NULL").select(F.col("_key").alias("key"), parts.alias("parts"))
    cells = sized.select("key", F.posexplode("parts").alias("pos", "unit")).withColumn("unit", normalised("unit")).where("unit <> ''")
    words = F.length("unit") - F.length(F.replace("unit", F.lit(" "), F.lit(""))) + 1
    return cells.select(
        "key", "pos", F.greatest(words, F.floor(F.length("unit") / WORD_CHARS).cast("int")).alias("words"), F.unhex(F.md5("unit")).alias("digest")
    )


def repeated_units(units: DataFrame) -> DataFrame:
    """``(key, pos, words)`` of every unit whose digest also occurs earlier: under a smaller key, or before in the same text."""
    place = F.struct("key", "pos")
    first = stored(
        units.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("digest", "first"),
        "first",
    )
    # The same join at every size. Both sides are plain scans of the join key, so adaptive execution can split a digest met very often.
    return units.join(first.hint("merge"), "digest").where(place > F.col("first")).select("key", "pos", "words")


def runs(units: list[tuple[int, int, bool]], words: dict[int, int], least: int) -> list[list[int]]:
    """Character spans of the units to cut, joined where they touch, from (start, end, blank) of all units of a text.

    ``words`` has the words of each repeated unit by its number. Units are a run if only blank ones stand between them.
    """
    spans, run, weight = [], [], 0

    def end_run():
        if weight >= least:
            for a, b in run:
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])

    for pos, (a, b, blank) in enumerate(units):
        if pos in words:
            run.append((a, b))
            weight += words[pos]
        elif not blank:
            end_run()
            run, weight = [], 0
    end_run()
    return spans


def _cut(pattern: str, least: int, schema: pa.Schema, at: int):
    """``at``: which field of ``row`` is the text; texts are sent to Python once, inside ``row``."""
    compiled = re.compile(pattern)

    def run(batches):
        for batch in batches:
            kept, cut = [], []
            texts, again = named(batch, "row").field(at), named(batch, "again")
            for row in range(batch.num_rows):
                # A text whose repeated units are too few words in all needs no second look.
                words = {u["pos"]: u["words"] for u in again[row].as_py() or ()}
                text = texts[row].as_py()
                if text is None or sum(words.values()) < least:
                    kept.append(text)
                    cut.append([])
                    continue
                spans = runs([(*m.span(), not m[0].strip(_SPACE)) for m in compiled.finditer(text)], words, least)
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept.append("".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                cut.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [named(batch, "row"), pa.array(kept, schema.types[1]), pa.array(cut, schema.types[2])], schema=pa.schema(
                    [pa.field("row", named(batch, "row").type), schema.field(1), schema.field(2)]
                )
            )
            del batch, texts, again, kept, cut
            pa.default_memory_pool().release_unused()

    return run


def dedup_substrings(docs: DataFrame, pattern: str = UNIT, run_words: int = RUN_WORDS) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with ``kept_text`` and the ``removed`` spans.

    A unit is a stretch of a line up to its full stops (``pattern=LINE``: a whole line), compared after
    normalisation by its 128-bit digest. Over all documents the occurrence with the smallest (doc_id, position)
    stays. The others go where they stand in a run of such units, blank ones between them aside, that has at least
    ``run_words`` words together; ``WORD_CHARS`` characters count as a word at least, so scripts without spaces take
    part. ``removed`` holds (start, end) in characters of the original text, joined where they touch.

    A null text stays null, an empty one empty. Rows with a null id rank last. Texts that share an id, or have none,
    are documents of their own, ranked by digest; only rows equal in id and text count as one document and are cut
    alike. Empty table: no rows. Other columns stay in ``row``.
    """
    names, docs = docs.columns, plain_names(docs)
    keys = row_keys(docs)
    keyed = with_keys(in_batches(docs), keys)
    units = stored(_units(keyed, pattern), "units")
    again = stored(
        repeated_units(units).groupBy("key").agg(F.collect_set(F.struct("pos", "words")).alias("again")).withColumnRenamed("key", "_id"), "again"
    )
    dropped(units)
    wide = keyed.select(F.struct(*(F.col(c).alias(name) for c, name in zip(docs.columns, names))).alias("row"), "_key")
    schema = wide.select("row").schema.add("kept_text", "string").add("removed", _SPANS)
    arrow = pa.schema([("row", pa.null()), ("kept_text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    # ``again`` grows with the documents, so it is never broadcast; the text crosses the shuffle once, inside ``row``.
    met = wide.join(again.hint("merge"), wide["_key"] == again["_id"], "left")
    return met.select("row", "again").mapInArrow(_cut(pattern, run_words, arrow, docs.columns.index("text")), schema)
