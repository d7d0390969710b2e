"""Sharding by extendible hashing.

A document's shard is a prefix of the bits of its hash. A directory says for each prefix how many bits its shard has: a
bucket over the byte limit is split on another bit, others stay whole. The directory is built in rounds of eight bits. Each
round sums the bytes of the rows still open by their prefix, finds for each of the 256 entries below an open bucket the
shortest prefix that fits, and assigns its rows; rows of buckets that fit nowhere stay open. So a round looks only at what
earlier ones had to split, and its windows hold 256 rows.

A document above the limit gets a shard of its own. Rows that share an id share 60 bits of hash; after these, 60 bits
of a hash of the row's number in the written table split them. Null texts have no bytes; null ids hash as the empty
text. An empty table gives an empty result. Other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import keep

LIMIT = 32 << 20
BITS = 60
STEP = 8
SEED = "shard"


def _digest(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def hash_of(key: Column, seed: str = SEED) -> Column:
    return _digest(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def _prefix(bits: int) -> Column:
    """The first ``bits`` bits of h and, beyond 60, of h2 as text of 0 and 1, joined to a key."""
    def text(of: str, n: int) -> Column:
        return F.lpad(F.bin(F.shiftright(of, BITS - n)), n, "0") if n else F.lit("")

    return F.concat(text("h", min(bits, BITS)), text("h2", max(0, bits - BITS)))


def shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, bytes, depth, shard, shard_bytes, shard_docs`` of every row; ``shard`` is the prefix in bits."""
    key = F.col(id_col)
    open_rows = keep(docs.select(key.alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
                                 hash_of(key).alias("h"), F.monotonically_increasing_id().alias("row")))
    open_rows = open_rows.withColumn("h2", _digest(F.concat(F.lit("row:"), F.col("row").cast("string"))))
    done = None
    for begin in range(0, 2 * BITS, STEP):
        end = min(begin + STEP, 2 * BITS)
        sums = open_rows.groupBy(_prefix(end).alias("entry")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        depth = F.lit(None).cast("int")
        size, many = F.lit(None).cast("long"), F.lit(None).cast("long")
        for d in range(end, begin - 1 if begin == 0 else begin, -1):
            bucket = Window.partitionBy(F.substring("entry", 1, begin), F.substring("entry", begin + 1, d - begin))
            total, count = F.sum("bytes").over(bucket), F.sum("n").over(bucket)
            fits = (total <= limit) | (count == 1)
            depth, size, many = F.when(fits, d).otherwise(depth), F.when(fits, total).otherwise(size), F.when(fits, count).otherwise(many)
        directory = keep(sums.select("entry", depth.cast("int").alias("depth"), size.alias("shard_bytes"), many.alias("shard_docs")))
        placed = open_rows.withColumn("entry", _prefix(end)).join(directory, "entry")
        part = placed.where("depth is not null").select(
            "doc_id", "bytes", "depth", F.expr("substring(entry, 1, depth)").alias("shard"), "shard_bytes", "shard_docs")
        done = part if done is None else done.unionAll(part)
        if directory.where("depth is null").isEmpty():
            break
        open_rows = keep(placed.where("depth is null").select("doc_id", "bytes", "h", "h2"))
    return done


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The documents as one folder of files per shard; ids are unique."""
    of = shards(docs, limit, id_col, text_col).select(F.col("doc_id").alias("_id"), F.concat(F.lit("b"), "shard").alias("shard_prefix"))
    placed = docs.join(of, docs[id_col].eqNullSafe(of["_id"])).drop("_id")
    placed.repartition("shard_prefix").write.partitionBy("shard_prefix").parquet(path)


def sql(table: str = "documents", limit: int = LIMIT, deepest: int = 40) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM {table}),
p AS (SELECT d.*, k::INTEGER AS depth, CASE WHEN k = 0 THEN '' ELSE lpad(bin(h >> ({BITS} - k)), k, '0') END AS shard
      FROM d, (SELECT unnest(range(0, {deepest + 1}))::INTEGER AS k)),
s AS (SELECT *, sum(bytes) OVER (PARTITION BY depth, shard)::BIGINT AS shard_bytes,
             count(*) OVER (PARTITION BY depth, shard)::BIGINT AS shard_docs FROM p)
SELECT doc_id, bytes, depth, shard, shard_bytes, shard_docs FROM s WHERE shard_bytes <= {limit} OR shard_docs = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1"""
