"""Jump consistent hashing of document ids to shards, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ranked

_STEP = 2862933555777941757  # multiplier of the published generator
_LOW, _HIGH = _STEP & 0xFFFFFFFF, _STEP >> 32
_WORD = 0xFFFFFFFF


def _advance(high: Column, low: Column) -> tuple[Column, Column]:
    """(high, low) halves of ``key * _STEP + 1`` modulo 2**64, from products that stay below 2**63."""
    low0, low1 = low.bitwiseAND(0xFFFF), F.shiftright(low, 16)
    part = low0 * F.lit(_LOW) + 1
    upper = low1 * F.lit(_LOW) + F.shiftright(part, 16)
    new_low = F.shiftleft(upper.bitwiseAND(0xFFFF), 16).bitwiseOR(part.bitwiseAND(0xFFFF))
    carry = F.shiftright(upper, 16)

    def product(x: Column, factor: int) -> Column:  # modulo 2**32
        tall = (F.shiftright(x, 16) * F.lit(factor)).bitwiseAND(0xFFFF)
        return (x.bitwiseAND(0xFFFF) * F.lit(factor) + F.shiftleft(tall, 16)).bitwiseAND(_WORD)

    new_high = (product(high, _LOW) + product(low, _HIGH) + carry).bitwiseAND(_WORD)
    return new_high, new_low


def jump_path(key: Column, shards: int) -> Column:
    """Struct (shard, grown): the bucket of a 64-bit key among ``shards`` and among ``shards + 1``.

    The published loop visits buckets in rising order and stops at the first beyond the shard count, so one
    walk gives both answers. It takes at most ``shards + 1`` steps.
    """
    total = shards + 1
    key = F.coalesce(key.cast("long"), F.lit(0))
    start = F.struct(
        F.shiftrightunsigned(key, 32).cast("long").alias("high"), key.bitwiseAND(_WORD).cast("long").alias("low"),
        F.lit(0).cast("long").alias("next"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def step(state: Column, _: Column) -> Column:
        here = state["next"]
        high, low = _advance(state["high"], state["low"])
        jump = F.floor((here + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(
            high.cast("long").alias("high"), low.cast("long").alias("low"), jump.alias("next"),
            F.when(here < shards, here).otherwise(state["shard"]).alias("shard"), here.alias("grown"))
        return F.when(here < total, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(total)), start, step, lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def assign_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Place every row by the ``key`` law: doc_id and the shard count alone decide.

    Returns doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot, grown_shard. Slots follow doc_id, then
    size and checksum, inside a shard; repeated rows get neighbouring slots. A null doc_id is placed as key 0, a
    null text counts as empty; an empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    path = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        jump_path(F.col("doc_id"), shards).alias("_path"))
    placed = path.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_path.shard").alias("shard"), F.col("_path.grown").alias("grown_shard"))
    out = ranked(placed, "shard", [F.col("doc_id"), F.col("size"), F.col("text_crc32")], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
