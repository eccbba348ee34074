"""Shard placement by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime
size: an offset and a step, both hashed from its name.  Shards take turns, and
each claims the first slot of its order that is still free, until the table is
full.  A key's hash names a slot, and the slot its shard.  Slots differ by one
at most between shards, and when a shard comes or goes few keys move.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS, SLOTS_PER_SHARD = 32, 100


def prime_from(n: int) -> int:
    """The smallest prime that is at least ``n`` (and 2)."""
    n = max(2, n)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def table_size(shards: int, per_shard: int = SLOTS_PER_SHARD) -> int:
    return prime_from(shards * per_shard)


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(names: list[str], size: int) -> list[int]:
    """The number of the shard that holds each slot; ``size`` is a prime above the number of shards."""
    if not names or len(set(names)) < len(names) or size <= len(names) or prime_from(size) != size:
        raise ValueError("shards need distinct names and a table of prime size above their number")
    at = [_number(f"offset:{n}") % size for n in names]
    step = [_number(f"step:{n}") % (size - 1) + 1 for n in names]
    table, left = [-1] * size, size
    while left:
        for shard in range(len(names)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            table[at[shard]] = shard
            left -= 1
            if not left:
                break
    return table


def shard_names(shards: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(shards)]


def slot_of(key: Column, size: int) -> Column:
    """The slot of a key, by the first 60 bits of the MD5 of its text."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long") % size


def place(df: DataFrame, key: str, names: list[str] | None = None, size: int | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` of each row; columns of these names are replaced.

    Equal keys share a shard.  Rows with a null key have nothing to be found
    by, so they are spread by a hash of all their columns instead of filling
    one shard.  The table is broadcast: its size follows from the number of
    shards, never from the rows, and placement moves no row.
    """
    names = names or shard_names(SHARDS)
    size = size or table_size(len(names))
    spark = df.sparkSession
    table = spark.createDataFrame(list(enumerate(lookup_table(names, size))), "slot long, shard int")
    rest = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]))
    slot = slot_of(F.coalesce(F.col(key).cast("string"), content), size)
    return df.select(*[F.col(f"`{c}`") for c in rest], slot.alias("slot")).join(F.broadcast(table), "slot").select(*rest, "slot", "shard")


def write_shards(df: DataFrame, path: str, key: str, names: list[str] | None = None, files_per_shard: int = 1) -> None:
    """Writes ``df`` as Parquet, one folder for each shard, with ``files_per_shard`` files in it.

    Rows of a shard are dealt to its files by a hash of the key, or of the row if that is null.
    """
    placed = place(df, key, names).drop("slot")
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in placed.columns]))
    part = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), content), F.lit("file")), F.lit(files_per_shard))
    n = len(names or shard_names(SHARDS)) * files_per_shard
    placed.repartition(n, "shard", part).write.partitionBy("shard").parquet(path)


#: The table and the placement as DuckDB SQL: one step of the recursion is one shard's turn.
ORACLE_SQL = """
WITH RECURSIVE shards AS (
    SELECT i AS shard, ('0x' || substr(md5('offset:shard-' || lpad(i::VARCHAR, 5, '0')), 1, 15))::BIGINT % {size} AS first,
           ('0x' || substr(md5('step:shard-' || lpad(i::VARCHAR, 5, '0')), 1, 15))::BIGINT % ({size} - 1) + 1 AS step
    FROM range({shards}) t(i)),
orders AS (
    SELECT shard, list((first + j * step) % {size} ORDER BY j) AS slots FROM shards, range({size}) r(j) GROUP BY shard),
fill AS (
    SELECT 0 AS turn, -1::BIGINT AS slot, -1::BIGINT AS shard, list_transform(range({size}), lambda x: true) AS free
    UNION ALL
    SELECT turn + 1, pick, t.shard, list_concat(list_concat(free[1:pick], [false]), free[pick + 2:])
    FROM (SELECT turn, free, orders.shard, list_filter(slots, lambda s: free[s + 1])[1] AS pick
          FROM fill JOIN orders ON orders.shard = turn % {shards} WHERE turn < {size}) t)
SELECT doc_id, slot, fill.shard::INTEGER AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % {size} AS slot FROM documents) JOIN fill USING (slot)
"""


def oracle_sql(shards: int = SHARDS) -> str:
    return ORACLE_SQL.format(shards=shards, size=table_size(shards))
