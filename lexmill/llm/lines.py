"""Line dedup with DataFrame functions alone.

Hashes of line keys are range-partitioned and sorted by key, then by document from the largest down, text and position. Windows stream over that order: the
first document of a key keeps its lines, the third makes the key frequent. A key that a sample shows to be hot is dealt in slots by a hash of the document; each
slot is streamed on its own, and one row a slot with its count and first document settles the whole key. What comes back for each document is a sparse bitmap of
its lines, not text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import ASCII_SPACE, LOWER, UPPER, cut_lineage, shuffle_parts

#: Lines in a word of a bitmap.
WORD = 32
_FULL = (1 << WORD) - 1


def split_lines(text_col: str) -> Column:
    """The lines of a text; one empty line for a null or empty one."""
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")


def line_keys(docs: DataFrame, least_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, body, pos, h1, h2): a row for each line whose key has at least ``least_chars`` code points. ``body`` tells texts of one id apart."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("body"), F.posexplode(split_lines(text_col)).alias("pos", "line"))
    keyed = rows.select("doc", "body", "pos", F.translate(F.btrim("line", F.lit(ASCII_SPACE)), UPPER, LOWER).alias("key")).where(F.length("key") >= least_chars)
    return keyed.select("doc", "body", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


#: Sampled rows for each partition, and how many of them make a key hot: one with an eighth of a partition's rows or more.
SAMPLED, HOT = 64, 8


def hot_keys(lines: DataFrame, parts: int) -> DataFrame:
    """(h1, h2) of the keys that have ``HOT`` rows or more in a sample of about ``SAMPLED`` rows a partition, so at most SAMPLED / HOT keys a partition.

    The sample decides alone how rows are dealt, as that of a range partitioning does: no result hangs on it.
    """
    share = min(1.0, SAMPLED * parts / max(1, lines.count()))
    sample = lines.sample(share, seed=10) if share < 1 else lines
    return sample.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= HOT).select("h1", "h2")


def first_occurrences(lines: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
    """``lines`` with slot (0 but for hot keys), and of a key's rows in its slot: docs, how many ids they are of, first, the largest of these, and head, true for one of them.

    ``hot`` is a bounded table. The windows need no exchange and no sort beside the range partitioning and the sort written here.
    """
    marked = lines.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), ["h1", "h2"], "left")
    slotted = marked.withColumn("slot", F.when(F.col("_hot"), F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int") + 1).otherwise(0)).drop("_hot")
    stream = slotted.repartitionByRange(parts, "h1", "h2", "slot").sortWithinPartitions("h1", "h2", "slot", F.desc("doc"), "body", "pos")
    key = Window.partitionBy("h1", "h2", "slot")
    down = key.orderBy(F.desc("doc"))
    seen = stream.select("*", F.dense_rank().over(down).alias("_nth"), F.first("doc").over(down).alias("first"), (F.row_number().over(down) == 1).alias("head"))
    return seen.withColumn("docs", F.max("_nth").over(key)).drop("_nth")


def dropped_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, body, pos) of the lines that go: those of a key that at least ``least_docs`` distinct ids hold, but in the largest of them."""
    parts = shuffle_parts(docs.sparkSession)
    lines = cut_lineage(line_keys(docs, least_chars, id_col, text_col))
    stream = first_occurrences(lines, cut_lineage(hot_keys(lines, parts)), parts)
    # What is settled as kept goes here; the lines of hot keys wait for the other slots.
    open_lines = cut_lineage(stream.where((F.col("slot") > 0) | ((F.col("docs") >= least_docs) & (F.col("doc") != F.col("first")))))
    whole = open_lines.where("slot > 0 AND head").groupBy("h1", "h2").agg(F.sum("docs").alias("_docs"), F.max("first").alias("_first"))
    settled = open_lines.join(F.broadcast(whole), ["h1", "h2"], "left")
    return settled.where(F.col("_docs").isNull() | ((F.col("_docs") >= least_docs) & (F.col("doc") != F.col("_first")))).select("doc", "body", "pos")


def keep_bitmaps(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, body, words): for each text that loses a line, the words of its keep bitmap that have a cleared bit, as structs of word and bits in order.

    A key that at least ``least_docs`` distinct ids hold keeps its lines in the largest of them only; all of them, if it has several there. A document's bits are
    gathered in one task, and bounded by its own lines.
    """
    dropped = dropped_lines(docs, least_chars, least_docs, id_col, text_col)
    word = F.floor(F.col("pos") / WORD).cast("int")
    words = dropped.groupBy("doc", "body", word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("gone"))
    cleared = words.select("doc", "body", F.struct("word", (F.lit(_FULL).cast("long") - F.col("gone")).alias("bits")).alias("w"))
    return cleared.groupBy("doc", "body").agg(F.sort_array(F.collect_list("w")).alias("words"))


def bitmap_mask(words: Column) -> Column:
    """One byte a line, '0' for a line to drop, up to the last word that has one; binary, so that a byte is found at once."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.element_at(words, F.greatest(i, F.lit(1)))["word"])
    text = lambda w, i: F.concat(F.repeat(F.lit("1"), (w["word"] - before(i) - 1) * WORD), F.reverse(F.lpad(F.bin(w["bits"]), WORD, "0")))
    return F.encode(F.array_join(F.transform(words, text), ""), "UTF-8")


#: Bits of a filter for each text that loses a line, and of the largest filter that is made: 4 MB, for 4 million texts.
FILTER_BITS, MOST_BITS = 8, 25


def maybe_marked(docs: DataFrame, marks: DataFrame, id_col: str) -> DataFrame | None:
    """``docs`` with ``_maybe``, false only for texts without a mark, by a bitmap that is sent to all tasks; None for more marks than the largest one is good for.

    ``marks`` has _doc and _body, ``docs`` the id and _own. A bitmap is a row for each 32,768 places, so at most 1,024 rows.
    """
    count = marks.count()
    bits = max(15, math.ceil(math.log2(FILTER_BITS * max(1, count))))
    if bits > MOST_BITS:
        return None
    place = lambda doc, body: F.pmod(F.xxhash64(doc, body), F.lit(1 << bits)) + 1
    slots = marks.select(place("_doc", "_body").alias("p")).select(F.bitmap_bucket_number("p").alias("_bucket"), F.bitmap_bit_position("p").alias("at"))
    bitmap = slots.groupBy("_bucket").agg(F.bitmap_construct_agg("at").alias("_bitmap"))
    placed = docs.withColumn("_at", F.bitmap_bit_position(place(id_col, "_own"))).withColumn("_bucket", F.bitmap_bucket_number(place(id_col, "_own")))
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1")
    found = placed.join(F.broadcast(bitmap), "_bucket", "left").withColumn("_byte", byte)
    return found.withColumn("_maybe", F.coalesce(bit, F.lit(0)) == 1).drop("_bucket", "_bitmap", "_byte", "_at")


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without its dropped lines, with n_lines (before) and n_dropped in one struct ``_lines``.

    Only texts that a filter of the marked ones lets pass are moved to their bitmaps, while such a filter is small enough to be sent to all tasks.
    """
    marks = cut_lineage(bitmaps.select(F.col("doc").alias("_doc"), F.col("body").alias("_body"), bitmap_mask(F.col("words")).alias("_mask")))
    own = docs.withColumn("_own", F.xxhash64(F.col(text_col)))
    split = maybe_marked(own, marks, id_col)
    moved = split.where("_maybe").drop("_maybe") if split is not None else own
    joined = moved.join(marks, (F.col(id_col) == F.col("_doc")) & (F.col("_own") == F.col("_body")), "left").drop("_doc", "_body")
    if split is not None:
        joined = joined.unionByName(split.where(~F.col("_maybe")).drop("_maybe").withColumn("_mask", F.lit(None).cast("binary")))
    lines = split_lines(text_col)
    kept = F.when(F.col("_mask").isNull(), lines).otherwise(F.filter(lines, lambda x, i: F.coalesce(F.substring(F.col("_mask"), i + 1, F.lit(1)), F.lit(b"")) != F.lit(b"0")))
    out = joined.withColumn("_n", F.size(lines)).withColumn("_kept", kept)
    text = F.when(F.col("_mask").isNull(), F.col(text_col)).otherwise(F.array_join("_kept", "\n"))
    plain = [F.col(c) if c != text_col else text.alias(text_col) for c in docs.columns]
    return out.select(*plain, F.struct(F.col("_n").cast("long").alias("n_lines"), (F.col("_n") - F.size("_kept")).cast("long").alias("n_dropped")).alias("_lines"))


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text of each row without its dropped lines, and ``_lines``.

    Null and empty texts are one empty line and stay as they are. Rows with a null id lose nothing and count for nothing. Repeated rows are one document
    and lose the same lines; texts that share an id are one document too, each with its own bitmap. Other columns are passed on.
    """
    return drop_lines(docs, keep_bitmaps(docs, least_chars, least_docs, id_col, text_col), id_col, text_col)


#: The same in SQL, on a table ``documents``. DuckDB's lower() is not that of A-Z alone, hence translate().
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
