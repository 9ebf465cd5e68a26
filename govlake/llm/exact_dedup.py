"""Exact dedup by deterministic block naming (DataFrame functions only).

Every text is cut into fixed-size byte blocks. All distinct blocks are sorted and
numbered, so equal blocks have one integer name and different blocks never share
one. Adjacent names are then paired and the distinct pairs sorted and numbered
again, level by level, until one name per text is left. (byte length, name) is the
identity of a text: two rows have the same identity if and only if their texts
are byte-equal.

How it runs at scale:

* A block travels as bytes once, in the partial-aggregated ``distinct`` that feeds
  the sort; one copy per map task of a block that half of the corpus holds.
* Blocks find their name again by a 128-bit address. The table of names shows whether
  the address tells all distinct blocks apart; if ever not, it is built anew with
  another seed. So equal names mean equal bytes, not just equal hashes.
* Numbers are given per sorted partition (partition number and place in it), no
  global order and no single task. The table of names is written before it is used.
* Levels beyond the first touch only texts that still have two or more names, and
  each level halves what is left.

Edge cases: a null text counts as empty; all empty texts are one group (identity:
length 0). Rows with a null doc_id take part; in ``keep_id`` a null doc_id loses
against any other and a group of nulls has keep_id null, with exactly one row kept.
Rows that repeat a doc_id and a text: one of them is kept. An empty table gives an
empty result. Columns beside ``id_col`` and ``text_col`` may have any names: the
operator reads those two only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, staged

BLOCK_BYTES = 2048


def _blocks(n_bytes: Column, data: Column, size: int) -> Column:
    """Array of the fixed-size blocks of a binary column (empty text: empty array)."""
    count = F.ceil(n_bytes / F.lit(size)).cast("int")
    return F.when(n_bytes == 0, F.array().cast("array<binary>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
                    lambda i: F.substring(data, i * size + 1, F.lit(size))))


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Integer names from 1 in the order of each (hash-dealt) partition."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id() + 1)


def _regather(named: DataFrame) -> DataFrame:
    """(rid, pos, name) rows back to one array of names per text."""
    return named.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("s")).select(
        "rid", F.col("s.name").alias("names"))


def _address(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), block).alias("h1"), F.xxhash64(F.lit(seed + 1), block).alias("h2")]


def text_identity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, seed: int = 0) -> DataFrame:
    """One row per input row: rid, the id, n_bytes, text_sha256 and the identity (n_bytes, name)."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    src = src.withColumn("n_bytes", F.octet_length("data").cast("long"))
    blocks = _blocks(F.col("n_bytes"), F.col("data"), block_bytes)

    # all distinct blocks, sorted and numbered; the address must tell every two of them apart
    distinct = src.select(F.explode(blocks).alias("block")).select(*_address(F.col("block"), seed), "block").distinct()
    table = staged(_numbered(distinct, ["block"]).select("h1", "h2", "name"), "names")
    if not table.groupBy("h1", "h2").count().where("count > 1").isEmpty():
        return text_identity(docs, id_col, text_col, block_bytes, seed + 2)

    # one pass for row ids, digests and the address of each block
    rows = staged(src.select(
        F.monotonically_increasing_id().alias("rid"), "id", "n_bytes", F.sha2("data", 256).alias("text_sha256"),
        F.transform(blocks, lambda b: F.struct(*_address(b, seed))).alias("marks")), "rows")
    parts = rows.select("rid", F.posexplode("marks").alias("pos", "m")).select("rid", "pos", "m.h1", "m.h2")
    todo = staged(_regather(parts.join(table, ["h1", "h2"]).select("rid", "pos", "name")), "level0")
    finished = todo
    level = 0
    while not (todo := todo.where(F.size("names") > 1)).isEmpty():
        level += 1
        half = F.ceil(F.size("names") / 2).cast("int")
        pair = F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.struct(
            F.get("names", i * 2).alias("a"), F.coalesce(F.get("names", i * 2 + 1), F.lit(0)).alias("b")))
        pairs = todo.select("rid", F.posexplode(pair).alias("pos", "p")).select("rid", "pos", "p.a", "p.b")
        table = staged(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), f"names{level}")
        todo = staged(_regather(pairs.join(table, ["a", "b"]).select("rid", "pos", "name")), f"level{level}")
        finished = finished.unionByName(todo)
    final = finished.where(F.size("names") == 1).select("rid", F.col("names")[0].alias("name"))
    return rows.drop("marks").join(final, "rid", "left").withColumn("name", F.coalesce("name", F.lit(0)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, n_bytes, copies.

    ``copies`` is the number of rows of the group that have this row's id.
    """
    ident = staged(text_identity(docs, id_col, text_col, block_bytes), "identity")
    # the largest id stays; of rows that repeat it, the one with the largest row number
    place = F.struct("id", "rid")
    # written first, so that Spark can split the rows of a large group in the join below
    groups = staged(ident.groupBy("n_bytes", "name").agg(F.count("*").alias("group_size"), F.max(place).alias("top")), "groups")
    same = ident.groupBy("n_bytes", "name", "id").agg(F.count("*").alias("copies")).where("copies > 1")
    out = ident.join(groups, ["n_bytes", "name"])
    out = out.join(same.withColumnRenamed("id", "sid").withColumnsRenamed({"n_bytes": "sb", "name": "sn"}),
                   (F.col("sb") == out.n_bytes) & (F.col("sn") == out.name) & F.col("sid").eqNullSafe(out.id), "left")
    return out.select(
        F.col("id").alias(id_col), F.col("top.id").alias("keep_id"), "group_size",
        (F.col("top.rid") == F.col("rid")).alias("kept"), "text_sha256", "n_bytes",
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, with all their columns."""
    own_id, own_sha, own_copies = free_names(docs, "__id", "__sha", "__copies")
    keep = staged(exact_dedup(docs, id_col, text_col).where("kept").select(
        F.col(id_col).alias(own_id), F.col("text_sha256").alias(own_sha), F.col("copies").alias(own_copies)), "kept")
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (sha == F.col(own_sha))
    once = docs.join(keep.where(F.col(own_copies) == 1), same, "left_semi")
    repeated = keep.where(F.col(own_copies) > 1)
    if repeated.isEmpty():
        return once
    return once.unionByName(docs.join(repeated, same).dropDuplicates([own_id, own_sha]).select(*[f"`{c}`" for c in docs.columns]))
