"""SimHash near-duplicates by multi-index hashing.

A text's 64-bit fingerprint takes each bit by majority over the hashes of its word shingles.
Fingerprints at most ``radius`` bits apart are linked, and linked fingerprints form
components.  Multi-index hashing: the fingerprint is cut into ``segments`` parts, so of two
linked ones at least one part differs by ``radius // segments`` bits at most; every distinct
fingerprint looks up the small Hamming ball round each of its parts in that part's table and
the whole distance of each match is verified.

Rows with the same fingerprint are one node, so copies are never paired.  Inside one look-up
key only a spanning forest of its links is passed on (any other link joins what is already
joined), computed in blocks of at most ``BLOCK`` fingerprints; keys with more are dealt out
as pairs of blocks.  Components are then found by contraction: every node hooks to its
smallest neighbour, chains are shortened, and the next round runs on what is left of the
graph, written to the checkpoint folder in between.

Null and empty texts have fingerprint zero, linked like any other.  Rows with a null id get
the component of their fingerprint; a component without any id has a null one.  Whole texts are
read, rows that repeat one another share their component, an empty table gives no rows, and
other columns are passed through whatever their names (but those of the result).
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hold, materialise, nothing
from tessera.llm.graph import components

SHINGLE = 3
RADIUS = 3
SEGMENTS = 2
SEED = 42
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        first = [0, *ends[:-shingle].tolist()]
        last = (ends[shingle - 1:] - 1).tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first, last)]
    bits = np.zeros(64, np.int64)
    h = np.array(hashes, "<u8")
    for a in range(0, len(h), 65536):
        bits += np.unpackbits(h[a:a + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed 64-bit integers."""

    @F.arrow_udf("long")
    def prints(source: pa.Array) -> pa.Array:
        hold("simhash", nothing)
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in source], "<u8").view("<i8"))

    return prints(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _balls(fp: Column, radius: int, segments: int) -> list[tuple[int, int, list[int]]]:
    """For each segment its first bit, width and the masks of its Hamming ball."""
    import itertools

    out = []
    for s in range(segments):
        low, high = 64 * s // segments, 64 * (s + 1) // segments
        width = high - low
        masks = [sum(1 << b for b in bits) for k in range(radius // segments + 1) for bits in itertools.combinations(range(width), k)]
        out.append((low, width, masks))
    return out


def _part(fp: Column, low: int, width: int, segment: int, segments: int) -> Column:
    """A segment's value with the segment's number above it, one look-up key for all tables."""
    value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
    return (value * segments + segment).alias("key")


def links(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that join all distinct values of ``fp`` at most ``radius`` bits apart:
    each link found, or for crowded look-up keys a forest with the same components."""
    if not 1 < segments <= radius + 1:
        raise ValueError("segments are from 2 to radius + 1")
    fp = F.col("fp")
    tables = _balls(fp, radius, segments)
    index = prints.select("fp", F.explode(F.array(*[_part(fp, low, width, s, segments) for s, (low, width, _) in enumerate(tables)])).alias("key"))
    probes = prints.select("fp", F.explode(F.concat(*[
        F.transform(F.array(*[F.lit(m) for m in masks]), functools.partial(_probe, fp, low, width, s, segments))
        for s, (low, width, masks) in enumerate(tables)])).alias("key"))
    crowded = materialise(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block))
    hits = probes.select(F.col("fp").alias("a"), "key")
    held = index.select(F.col("fp").alias("b"), "key")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    if crowded.isEmpty():
        return hits.join(held, (hits["key"] == held["key"]) & (F.col("a") < F.col("b")) & close).select("a", "b")
    keys = crowded.select("key")
    few = held.join(keys, "key", "left_anti")
    plain = hits.join(few, (hits["key"] == few["key"]) & (F.col("a") < F.col("b")) & close).select("a", "b")
    return plain.unionByName(_crowded(hits.join(keys, "key"), held.join(keys, "key"), radius, block))


def _probe(fp: Column, low: int, width: int, s: int, segments: int, mask: Column) -> Column:
    value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))
    return value.bitwiseXOR(mask) * segments + s


def _crowded(hits: DataFrame, held: DataFrame, radius: int, block: int) -> DataFrame:
    """Forests of the links inside crowded keys, one for each pair of blocks of fingerprints."""
    n_held = held.groupBy("key").agg(F.ceil(F.count("*") / block).alias("held_blocks"))
    n_hits = hits.groupBy("key").agg(F.ceil(F.count("*") / block).alias("hit_blocks"))
    blocks = n_held.join(n_hits, "key")
    i = F.pmod(F.xxhash64("b"), F.col("held_blocks")).alias("i")
    left = held.join(blocks, "key").select("key", i, F.explode(F.sequence(F.lit(0), F.col("hit_blocks") - 1)).alias("j"), F.col("b").alias("fp"), F.lit(True).alias("held"))
    j = F.pmod(F.xxhash64("a"), F.col("hit_blocks")).alias("j")
    right = hits.join(blocks, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("held_blocks") - 1)).alias("i"), j, F.col("a").alias("fp"), F.lit(False).alias("held"))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy(np.int64)
        x, y = values[group["held"].to_numpy(bool)], values[~group["held"].to_numpy(bool)]
        near = np.zeros((len(x), len(y)), bool)
        for k in range(0, len(x), 256):
            near[k:k + 256] = np.bitwise_count((x[k:k + 256, None] ^ y[None, :]).view(np.uint64)) <= radius
        big = np.iinfo(np.int64).max
        root_x, root_y = x.copy(), y.copy()
        while len(x) and len(y):  # the smallest value reachable inside the block pair
            down = np.minimum(root_y, np.where(near, root_x[:, None], big).min(0))
            over = np.minimum(root_x, np.where(near, down[None, :], big).min(1))
            if (down == root_y).all() and (over == root_x).all():
                break
            root_x, root_y = over, down
        a, b = np.r_[root_x, root_y], np.r_[x, y]
        return pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    return left.unionByName(right).groupBy("key", "i", "j").applyInPandas(forest, "a long, b long")


def _components(rows: DataFrame, radius: int, segments: int, block: int) -> DataFrame:
    """``fp`` and the ``root`` of its component, one row for each distinct fingerprint."""
    nodes = materialise(rows.select("fp").distinct())
    found = components(links(nodes, radius, segments, block)).withColumnRenamed("node", "fp")
    return nodes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest id reachable) of every row."""
    rows = materialise(df.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text).cast("string"), shingle).alias("fp")))
    rooted = _components(rows, radius, segments, block)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).join(rooted, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def representatives(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """One row of ``df`` for each component: that with the smallest id (null ids last)."""
    names = [F.col(f"`{c}`") for c in df.columns]
    tagged = df.withColumn("__row", F.xxhash64(*names))
    rows = materialise(tagged.select(F.col(doc_id).alias("__id"), "__row", fingerprint_column(F.col(text).cast("string"), shingle).alias("fp")))
    rooted = _components(rows, radius, segments, block)
    light = rows.groupBy("fp", "__id", "__row").agg(F.count("*").alias("__n"))
    first = (light.join(rooted, "fp").groupBy("root")
             .agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row", "__n")).alias("x"))
             .select(F.col("x.__id").alias("__id"), F.col("x.__row").alias("__key"), "x.__n"))
    kept = tagged.join(first, (tagged["__row"] == first["__key"]) & tagged[doc_id].eqNullSafe(first["__id"]))
    # a row that is there several times is kept once
    return kept.where("__n = 1").select(*names).unionByName(kept.where("__n > 1").select(*names).dropDuplicates())
