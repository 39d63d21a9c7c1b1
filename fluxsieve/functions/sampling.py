"""Keyed uniforms and inverse distribution functions.

A draw is a hash of (seed, draw, key, name), so two rows that share a key share the draw
without any join, any task can recompute it, and a lost executor changes nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from fluxsieve import fixed

TWO_53 = float(1 << 53)
TWO_40 = float(1 << 40)
PER_DIGEST = 3  # three 40-bit uniforms fit in one md5
CHUNK = 64  # draws whose uniforms travel as one array


def uniform(*keys: Column) -> Column:
    """Fast uniform in [0, 1) from a 64-bit hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") / F.lit(TWO_53)


def portable_digest(*keys: Column) -> Column:
    """Hash text other engines can reproduce, for cross-checks."""
    return F.md5(F.concat_ws(":", *[k.cast("string") for k in keys]).cast("binary"))


def portable_uniform(digest: Column, slot: int = 0) -> Column:
    """One of the three 40-bit uniforms held in a portable digest."""
    return (
        F.conv(F.substring(digest, 1 + 10 * slot, 10), 16, 10).cast("bigint").cast("double")
        / F.lit(TWO_40)
    )


def portable_uniforms(seed: int, draws: int, blocks: int, first: Column, *keys: Column) -> Column:
    """Array of the uniforms of ``CHUNK`` draws from draw ``first`` on (not beyond ``draws``), ``blocks`` digests a draw.

    Uniform ``i`` of a draw stands at ``uniform_at`` and equals slot ``i % PER_DIGEST`` of the portable digest of seed, draw,
    keys and ``i // PER_DIGEST``. Keys travel once per chunk of draws, and the bytes of all digests become numbers at once.
    """
    ends = [f":{b}".encode() for b in range(blocks)]

    def run(starts: pa.Array, tails: pa.Array) -> pa.Array:
        made, sizes = [], [0]
        for start, tail in zip(starts.to_pylist(), tails.cast(pa.binary()).to_pylist()):
            closing = [tail + end for end in ends]
            for draw in range(start, min(start + CHUNK, draws + 1)):
                head = b"%d:%d" % (seed, draw)
                made += [hashlib.md5(head + c, usedforsecurity=False).digest() for c in closing]
            sizes.append(len(made) * PER_DIGEST)
        halves = np.frombuffer(b"".join(made), ">u8").reshape(-1, 2).astype(np.uint64)
        high, low = halves[:, 0], halves[:, 1]
        slots = (high >> np.uint64(24), (high & np.uint64((1 << 24) - 1)) << np.uint64(16) | low >> np.uint64(48),
                 low >> np.uint64(8) & np.uint64((1 << 40) - 1))
        values = np.stack(slots, axis=1).ravel().astype(np.float64) / TWO_40
        return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))

    # a null key is left out of a digest's text
    return F.arrow_udf(run, "array<double>")(first, F.concat_ws(":", F.lit(""), *[k.cast("string") for k in keys]))


def uniform_at(uniforms: Column, blocks: int, draw: Column, first: Column, i: int) -> Column:
    """Uniform ``i`` of a draw in the array of its chunk."""
    return F.get(uniforms, (draw - first) * (PER_DIGEST * blocks) + i)


def chunk_starts(draws: int) -> Column:
    """Array of the first draws of all chunks."""
    return F.sequence(F.lit(1), F.lit(draws), F.lit(CHUNK))


def chunk_draws(first: Column, draws: int) -> Column:
    """Array of the draws of a chunk."""
    return F.sequence(first, F.least(first + (CHUNK - 1), F.lit(draws)))


def triangular(u: Column, lo: Column, mode: Column, hi: Column) -> Column:
    """Inverse CDF of the triangular distribution; a point when lo = hi."""
    width, left, right = hi - lo, mode - lo, hi - mode
    rising = lo + F.sqrt(u * width * left)
    falling = hi - F.sqrt((F.lit(1.0) - u) * width * right)
    return F.when(lo == hi, mode).when(u * width < left, rising).otherwise(falling)


def uniform_between(u: Column, lo: Column, hi: Column) -> Column:
    return lo + u * (hi - lo)


def lognormal(u1: Column, u2: Column, lo: Column, mode: Column, hi: Column) -> Column:
    """Lognormal with median ``mode`` and [lo, hi] read as its p5 to p95 span."""
    sigma = (F.log(hi) - F.log(lo)) / F.lit(fixed.LOGNORMAL_SPAN)
    normal = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0) * F.pi() * u2)
    return F.when(sigma <= 0, mode).otherwise(F.exp(F.log(mode) + sigma * normal))


def sample(rng: Column, u1: Column, u2: Column, dist: Column) -> Column:
    """One value of a range under its named distribution."""
    lo, mode, hi = rng["lo"], rng["expected"], rng["hi"]
    return (
        F.when(lo == hi, lo)
        .when(dist == "uniform", uniform_between(u1, lo, hi))
        .when((dist == "lognormal") & (lo > 0) & (mode > 0), lognormal(u1, u2, lo, mode, hi))
        .otherwise(triangular(u1, lo, mode, hi))
    )
