"""Near-duplicates by circulant MinHash.

Two permutations of the 32-bit numbers, of which the second is shifted by one more step for each coordinate, make a whole signature. Documents that agree in a
band of it are compared with the band's leader, every link is confirmed on the full sets of shingles, and components are grown from the links. Bands whose
documents are then not all of one component are searched again, between components.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lexmill.llm.common import LOWER, UPPER, cut_lineage, fields, map_rows, shuffle_parts
from lexmill.llm.components import components
from lexmill.llm.spans import key_filter

WORDS = 5
BANDS, ROWS = 32, 4
#: Of the signature's coordinates, how many must agree before full sets are compared. At a similarity of 0.75 fewer do in about one pair of 10^10.
AGREE = BANDS * ROWS // 2
#: Documents and shingles of a block; two blocks meet in one task.
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 4_000_000
_ODD = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint32(0x9E3779B1)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words; of the whole sequence if it is shorter; nothing without words.

    Words are runs of characters other than space and tab to carriage return, with A-Z lower-cased.
    """
    data = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    space = _SPACES[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(data)]))))
    term = np.where(space, np.uint64(0), _BYTES[data] * _powers(_ODD, int(place.max()) + 1)[place])
    word = _mix64(np.add.reduceat(term, starts) + lengths.astype(np.uint64) * np.uint64(_ODD))
    run = min(size, len(word))
    mixed = np.full(len(word) - run + 1, run, np.uint64)
    for j in range(run):
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + word[j : len(word) - run + 1 + j]
    return np.unique(_mix64(mixed))


def _first_permutation(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def _second_permutation(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = (np.arange(1, BANDS * ROWS + 1, dtype=np.uint32) * _STEP)[:, None]


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates: the least image of the set under the second permutation after circular shifts of the first one's image."""
    first = _first_permutation((hashes >> np.uint64(32)).astype(np.uint32))
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(first), 1024):
        np.minimum(out, _second_permutation(first[None, at : at + 1024] + _SHIFTS).min(axis=1), out=out)
    return out


def band_keys(sign: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is mixed in."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix64(key * np.uint64(_ODD) + sign.reshape(BANDS, ROWS)[:, j].astype(np.uint64))
    return key


def sketches(docs: DataFrame, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest, sign): digest names the set (null for an empty one), sign has the low 16 bits of each coordinate followed by the band keys."""
    schema = fields(docs, id_col, n_shingles=T.LongType(), digest=T.BinaryType(), sign=T.BinaryType())

    def make():
        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {id_col: cols[id_col], "n_shingles": [], "digest": [], "sign": []}
            for text in cols[text_col]:
                own = shingle_set(text or "", size)
                out["n_shingles"].append(len(own))
                out["digest"].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                sign = signature(own)
                out["sign"].append(sign.astype("<u2").tobytes() + band_keys(sign).astype("<u8").tobytes() if len(own) else None)
            return out

        return work

    return map_rows(docs.select(id_col, text_col), schema, make)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _bands(sign: pd.Series) -> pd.Series:
    return sign.map(lambda x: np.frombuffer(x, "<i8", offset=2 * BANDS * ROWS))


@F.pandas_udf(T.IntegerType())
def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    n = BANDS * ROWS
    x = np.frombuffer(b"".join(v[: 2 * n] for v in a), "<u2").reshape(-1, n)
    y = np.frombuffer(b"".join(v[: 2 * n] for v in b), "<u2").reshape(-1, n)
    return pd.Series((x == y).sum(axis=1).astype("int32"))


def _alike(n: Column, m: Column, percent: int) -> Column:
    """Sizes that can have the similarity at all."""
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (n > 0)


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link, with the number of agreeing coordinates."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sign").alias(f"sign{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").where(_alike(F.col("na"), F.col("nb"), percent))
    return met.withColumn("agree", _agreeing("signa", "signb")).where(F.col("agree") >= AGREE).select("a", "b", "agree")


def _sets(ends: DataFrame, docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles): the full sets of the nodes of ``ends`` (node, digest)."""
    # While a filter is small enough to be sent, it keeps the texts of most other documents from being shuffled; the join is exact.
    maybe = key_filter(ends.select(F.xxhash64("node").alias("h")))
    own = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
    texts = (own.where(maybe.test("h")) if maybe else own).drop("h").join(ends, "node")
    schema = fields(ends, "node", shingles=T.BinaryType())

    def make():
        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {"node": [], "shingles": []}
            for node, text, digest in zip(cols["node"], cols["text"], cols["digest"], strict=True):
                own = shingle_set(text or "", size).tobytes()
                if hashlib.blake2b(own, digest_size=16).digest() == digest:
                    out["node"].append(node)
                    out["shingles"].append(own)
            return out

        return work

    return cut_lineage(map_rows(texts.select("node", "text", "digest"), schema, make, rows=64).dropDuplicates(["node"]))


def linked(m: np.ndarray, n: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(m, n, assume_unique=True))
    return 100 * both >= percent * (len(m) + len(n) - both)


def confirm(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= percent * union holds for the full sets of shingles."""
    ends = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "digest"), "node"))
    sets = _sets(ends, docs, size, id_col, text_col)
    joined = pairs.select("a", "b").join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a").join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b")

    def check():
        def work(cols: dict[str, list]) -> dict:
            out: dict[str, list] = {"a": [], "b": []}
            for a, b, x, y in zip(cols["a"], cols["b"], cols["x"], cols["y"], strict=True):
                if linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent):
                    out["a"].append(a)
                    out["b"].append(b)
            return out

        return work

    return cut_lineage(map_rows(joined.select("a", "b", "x", "y"), fields(pairs, "a", "b"), check, rows=128))


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id (the least id reachable by links, its own included) and kept (id = component_id).

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of shingles. A null or empty text, or one without words, has no set and
    is linked with nothing. Rows that share an id are one document; for links its set is that of the least digest among them. Rows with a null id are
    linked with nothing, have a null component and are kept. Equal sets are one node, so that copies make no pairs. Other columns are not read. The block sizes
    bound what a task holds, and change no result.
    """
    rows = cut_lineage(sketches(docs, size, id_col, text_col))
    sets = rows.where(F.col("digest").isNotNull() & F.col(id_col).isNotNull())
    least = cut_lineage(sets.groupBy("digest").agg(F.min(id_col).alias("node")))
    nodes = least.groupBy("node").agg(F.min("digest").alias("digest"))
    kept = sets.select(F.col(id_col).alias("node"), "digest", F.col("n_shingles").alias("n"), "sign")
    nodes = cut_lineage(kept.join(nodes, ["node", "digest"]).dropDuplicates(["node"]))
    banded = nodes.select("node", F.explode(_bands("sign")).alias("key"))
    leaders = banded.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("many")).where("many > 1").select("key", "leader")
    shared = cut_lineage(banded.join(leaders, "key"))
    pairs = shared.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    likely = cut_lineage(_likely(pairs, nodes, percent))
    # First each document's likeliest leader alone, then what still joins different components.
    first = likely.groupBy("a").agg(F.max_by("b", F.struct("agree", F.col("b"))).alias("b"))
    links = confirm(first, docs, nodes, percent, size, id_col, text_col)
    links = _more(links, likely, first, docs, nodes, percent, size, id_col, text_col)
    comp = components(links)
    links = _between(links, comp, shared, nodes, docs, percent, size, id_col, text_col, block_docs, block_shingles)
    comp = components(links) if links is not None else comp
    # Every row finds its set's node, then its component.
    found = least.join(comp, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    own = rows.join(found, "digest", "left")
    component = F.coalesce(F.col("component"), F.col(id_col))
    component = F.when(F.col(id_col).isNull(), F.lit(None)).otherwise(component).cast(docs.schema[id_col].dataType)
    return own.select(id_col, "n_shingles", component.alias("component_id"), F.coalesce(F.col(id_col) == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 75, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, of which one document of each component stays, the one with the least id.

    Of rows that share an id the one with the least JSON text of its columns stays, so that a task that runs again keeps the same; rows with a null id all do. While
    a filter of the ids that lose a row is small enough to be sent, texts of other documents are not moved.
    """
    found = cut_lineage(near_duplicates(docs.select(id_col, text_col), percent, size, id_col, text_col).where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n")))
    touched = found.where("not kept or n > 1")
    maybe = key_filter(touched.select(F.xxhash64(id_col).alias("h")))
    marked = docs.withColumn("_h", F.xxhash64(id_col))
    held = F.col(id_col).isNotNull()
    if maybe:
        marked = marked.withColumn("_maybe", maybe.test("_h"))
        held = held & F.col("_maybe")
    rest = marked.where(held).select(*docs.columns).join(touched.where("not kept").select(id_col), id_col, "left_anti").select(*docs.columns)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = rest.groupBy(F.col(id_col).alias("_id")).agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
    return marked.where(~held).select(*docs.columns).unionByName(first)


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends are not of one component yet."""
    side = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    marked = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return marked.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _more(links: DataFrame, likely: DataFrame, first: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """Confirms the likely pairs that were not tried and whose ends the links so far leave apart."""
    rest = likely.select("a", "b").join(first, ["a", "b"], "left_anti")
    apart = cut_lineage(_apart(rest, components(links)))
    if apart.isEmpty():
        return links
    return links.union(confirm(apart, docs, nodes, percent, size, id_col, text_col))


def _blocks(own: DataFrame, block_docs: int, block_shingles: int) -> DataFrame:
    """``own`` (node, c, family, n, ..) with block, the blocks [low, high) of its component if that has some of its own, and how many the family has.

    A component of more than a block has blocks of its own, which need not meet one another; the other components of a family share blocks.
    """
    fill = F.greatest(F.ceil(F.sum("docs") / F.lit(block_docs)), F.ceil(F.sum("size") / F.lit(block_shingles))).cast("int")
    sized = own.groupBy("family", "c").agg(F.count("*").alias("docs"), F.sum("n").alias("size"))
    sized = cut_lineage(sized.withColumn("many", F.greatest(F.ceil(F.col("docs") / F.lit(block_docs)), F.ceil(F.col("size") / F.lit(block_shingles))).cast("int")))
    pool = sized.where("many = 1").groupBy("family").agg(fill.alias("pool"))
    large = sized.where("many > 1").select("family", "c", "many").join(pool, "family", "left")
    before = F.coalesce(F.sum("many").over(Window.partitionBy("family").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.coalesce("pool", F.lit(0))
    large = large.select("family", "c", before.cast("int").alias("low"), "many")
    total = pool.select("family", "pool").unionByName(sized.where("many > 1").groupBy("family").agg(F.sum("many").cast("int").alias("pool"))).groupBy("family").agg(F.sum("pool").cast("int").alias("total"))
    placed = own.join(pool, "family", "left").join(total, "family").join(large, ["family", "c"], "left")
    hashed = F.xxhash64("node")
    block = F.when(F.col("low").isNull(), F.pmod(hashed, F.col("pool"))).otherwise(F.col("low") + F.pmod(hashed, F.col("many"))).cast("int")
    return placed.withColumn("block", block).withColumn("high", F.col("low") + F.col("many")).drop("pool", "many")


def _between(links: DataFrame, comp: DataFrame, shared: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, size: int, id_col: str, text_col: str, block_docs: int, block_shingles: int) -> DataFrame | None:
    """All links with those between components that meet in a band; None if no band has two components.

    Documents that such bands connect are a family. A family is dealt into blocks of bounded size, each two of which meet in one task with their signatures: it
    looks at the pairs that share a band, are of different components and agree in enough coordinates, and names their documents. Full sets are sent for these
    alone, to the blocks where they were named, and a task gives back links. So no pairs are shuffled, however many documents are nearly alike without being linked.
    """
    marked = shared.join(comp, "node", "left").select("key", "node", "leader", F.coalesce("component", "node").alias("c"))
    mixed = marked.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high").select("key")
    met = cut_lineage(marked.join(mixed, "key").select("node", "leader", "c").distinct())
    if met.isEmpty():
        return None
    parts = shuffle_parts(docs.sparkSession)
    family = components(met.select(F.col("node").alias("a"), F.col("leader").alias("b"))).withColumnRenamed("component", "family")
    own = cut_lineage(met.select("node", "c").distinct().join(family, "node").join(nodes, "node"))
    placed = cut_lineage(_blocks(own.select("node", "c", "family", "n", "sign", "digest"), block_docs, block_shingles))
    others = F.filter(F.sequence(F.lit(0), F.col("total") - 1), lambda x: F.col("low").isNull() | (x < F.col("low")) | (x >= F.col("high")))
    sent = placed.withColumn("other", F.explode(others)).select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "c", "n", "sign")
    node = sent.schema["node"]
    found_schema = T.StructType([sent.schema["family"], *(T.StructField(x, T.IntegerType()) for x in "ij"), node])
    link_schema = to_arrow_schema(T.StructType([node, T.StructField("b", node.dataType)]))

    def name(part: pa.Table) -> pa.Table:
        at = np.zeros(part.num_rows, bool)
        for x, y in _meetings(part, percent):
            at[x] = True
            at[y] = True
        return part.filter(pa.array(at)).select(["family", "i", "j", "node"]).cast(to_arrow_schema(found_schema))

    def meet(part: pa.Table) -> pa.Table:
        found = _links_in(part, percent)
        ids = part.column("node").to_pylist()
        return pa.table([pa.array([ids[x] for x, _ in found], link_schema.types[0]), pa.array([ids[y] for _, y in found], link_schema.types[1])], schema=link_schema)

    # By block pairs: the exchange by family alone, which a join before leaves, would also do for the groups.
    named = sent.repartition(parts, "family", "i", "j").groupBy("family", "i", "j").applyInArrow(name, found_schema)
    named = cut_lineage(named)
    sets = _sets(named.select("node").distinct().join(nodes.select("node", "digest"), "node"), docs, size, id_col, text_col)
    dealt = named.join(placed.select("node", "block", "c", "n", "sign"), "node").join(sets, "node").repartition(parts, "family", "i", "j")
    more = dealt.groupBy("family", "i", "j").applyInArrow(meet, T.StructType([node, T.StructField("b", node.dataType)])).select(F.col("node").alias("a"), "b")
    return cut_lineage(links.union(more))


def _meetings(part: pa.Table, percent: int):
    """(x, ys): rows of two blocks (or of one that meets itself) of different components that share a band and agree in enough coordinates, each pair in its first band."""
    across = part.column("i")[0].as_py() != part.column("j")[0].as_py()
    block, n = part.column("block").to_numpy(), part.column("n").to_numpy()
    comp = pd.factorize(pd.Series(part.column("c").to_pylist()))[0]
    sign = np.frombuffer(b"".join(x.as_py() for x in part.column("sign")), np.uint8).reshape(len(n), -1)
    coords, keys = sign[:, : 2 * BANDS * ROWS].copy().view("<u2"), sign[:, 2 * BANDS * ROWS :].copy().view("<u8")
    for band in range(BANDS):
        order = np.argsort(keys[:, band], kind="stable")
        starts = np.flatnonzero(np.append(True, keys[order[1:], band] != keys[order[:-1], band]))
        for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
            rows = order[a:b]
            if len(rows) < 2 or (comp[rows] == comp[rows[0]]).all():
                continue
            for at, x in enumerate(rows[:-1]):
                y = rows[at + 1 :]
                y = y[(comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))]
                if across:
                    y = y[block[y] != block[x]]
                if band and len(y):
                    y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]  # met in an earlier band
                if len(y):
                    y = y[(coords[y] == coords[x]).sum(axis=1) >= AGREE]
                if len(y):
                    yield x, y


def _links_in(part: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links among the meetings of two blocks, but those whose components another link has joined already."""
    comp = pd.factorize(pd.Series(part.column("c").to_pylist()))[0]
    shingles = part.column("shingles")
    up, sets, found = list(range(int(comp.max()) + 1)), {}, []

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def own(x: int) -> np.ndarray:
        if x not in sets:
            sets[x] = np.frombuffer(shingles[x].as_py(), np.uint64)
        return sets[x]

    for x, ys in _meetings(part, percent):
        for z in ys:
            p, q = top(comp[x]), top(comp[z])
            if p != q and linked(own(x), own(z), percent):
                up[p] = q
                found.append((int(x), int(z)))
    return found


#: The same in SQL, on a table ``documents``: all pairs that share a shingle, which is for small tables.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{U}', '{L}'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT a, b FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
least_of AS (SELECT node, min(other) AS other FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) AS component_id, d.doc_id <= coalesce(l.other, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.node = d.doc_id
""".replace("{U}", UPPER).replace("{L}", LOWER)
