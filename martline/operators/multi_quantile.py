"""Exact order statistics of several measures at once, without a sort.

Rows are ordered by (measure, id), nulls of the measure last. Given ranks, the
key (measure, id) at each of them is found by radix histograms: one pass counts
the rows by the leading digit of every measure, which tells the digit at each
rank; the next pass counts, for the digits found, by the digit after; and so on
through the measure and then, among rows of that very measure, through the
bytes of the id. Each pass serves all measures and ranks: an aggregation whose
groups are bounded by ranks x digits, whatever the rows. When the rows that are
left are few, they are fetched instead."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a measure's digit, bytes of an id's digit.
BITS, BYTES = 12, 2
#: Rows left in all, at most, that are fetched and sorted instead of another pass.
FETCH = 4096


@dataclass
class _Search:
    """One measure, one rank: what is known of the key there."""
    measure: str
    rank: int          # among the rows that match what is known, from 1
    shift: int         # bits of the measure not known yet
    value: int = 0     # the known leading bits
    prefix: bytes = b""
    count: int = 0     # rows that match
    found: tuple[int, str] | None = None


def keys_at_ranks(df: DataFrame, measures: dict[str, Column], key: str,
                  ranks: Callable[[int], list[int]]) -> tuple[int, dict[str, list[tuple[int | None, str] | None]]]:
    """(number of rows, for each measure the (value, id) at each of
    ``ranks(n)``, from 1; None for a rank beyond n).

    ``measures`` are whole numbers (bigint) or null; ``key`` is the id, text
    and not null, best unique (equal keys give the same answer at their ranks).
    ``df`` is read once a pass: write it before."""
    spread = df.select(*[x for i, c in enumerate(measures.values()) for x in (
        F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))], F.count(F.lit(1)).alias("n"))
    edge = spread.first()
    n = edge["n"]
    wanted = ranks(n)
    lows, bits, x = {}, {}, {}
    for i, (name, c) in enumerate(measures.items()):
        low, high = edge[f"lo{i}"] or 0, edge[f"hi{i}"] or 0
        lows[name] = low
        # From 0 on; null stands above every value.
        bits[name] = max(1, (high - low + 1).bit_length())
        if bits[name] > 62:
            raise ValueError(f"{name}: the values are more than 2**62 apart")
        x[name] = F.coalesce(c - F.lit(low), F.lit(high - low + 1)).cast("long")
    searches = {m: [_Search(m, r, bits[m], count=n) if 1 <= r <= n else None for r in wanted] for m in measures}

    def open_searches() -> dict[tuple, list[_Search]]:
        """Searches not ended, those that share all they know together."""
        out: dict[tuple, list[_Search]] = {}
        for s in (s for own in searches.values() for s in own if s and s.found is None):
            out.setdefault((s.measure, s.shift, s.value, s.prefix), []).append(s)
        return out

    def matches(m: str, shift: int, value: int, prefix: bytes) -> Column:
        known = F.shiftright(x[m], shift) == F.lit(value)
        if prefix:
            known &= F.substring(F.col(key).cast("binary"), 1, len(prefix)) == F.lit(prefix)
        return known

    while groups := open_searches():
        states = list(groups)
        left = sum(groups[s][0].count for s in states)
        if left <= FETCH:
            parts = F.filter(F.array(*[F.when(matches(*s), F.struct(
                F.lit(i).alias("i"), x[s[0]].alias("x"), F.col(key).alias("id"))) for i, s in enumerate(states)]), F.isnotnull)
            rows: dict[int, list] = {}
            for r in df.select(F.explode(parts).alias("r")).select("r.*").collect():  # FETCH rows at most
                rows.setdefault(r.i, []).append((r.x, r.id.encode(), r.id))
            for i, s in enumerate(states):
                own = sorted(rows[i])
                for search in groups[s]:
                    search.found = (own[search.rank - 1][0], own[search.rank - 1][2])
            break
        digits = []
        for i, (m, shift, value, prefix) in enumerate(states):
            if shift:
                step = min(BITS, shift)
                digit = F.shiftright(x[m], shift - step).bitwiseAND(F.lit((1 << step) - 1)).cast("string")
            else:
                digit = F.hex(F.substring(F.col(key).cast("binary"), len(prefix) + 1, BYTES))
            digits.append(F.when(matches(m, shift, value, prefix), F.struct(F.lit(i).alias("i"), digit.alias("digit"))))
        counted = df.select(F.explode(F.filter(F.array(*digits), F.isnotnull)).alias("r")).groupBy("r.i", "r.digit").count()
        histogram: dict[int, list] = {}
        for r in counted.collect():  # a row for each state and digit
            histogram.setdefault(r["i"], []).append((r["digit"], r["count"]))
        for i, s in enumerate(states):
            m, shift, value, prefix = s
            numbers = sorted((int(d), c) for d, c in histogram[i]) if shift else sorted(
                (bytes.fromhex(d), c) for d, c in histogram[i])
            for search in groups[s]:
                for digit, count in numbers:
                    if search.rank <= count:
                        break
                    search.rank -= count
                search.count = count
                if shift:
                    step = min(BITS, shift)
                    search.shift, search.value = shift - step, value << step | digit
                else:
                    search.prefix = prefix + digit
                    if len(digit) < BYTES:  # the id ends here
                        search.found = (value, search.prefix.decode())
    out: dict[str, list] = {}
    for m, own in searches.items():
        top = 1 + ((edge[f"hi{list(measures).index(m)}"] or 0) - lows[m])
        out[m] = [None if s is None else (None if s.found[0] == top else s.found[0] + lows[m], s.found[1]) for s in own]
    return n, out


def at_or_after(measure: Column, key: Column, cut: tuple[int | None, str]) -> Column:
    """Does (measure, key) stand at ``cut`` or after it? Nulls stand last."""
    value, id_ = cut
    if value is None:
        return measure.isNull() & (key >= F.lit(id_))
    return F.coalesce((measure > F.lit(value)) | ((measure == F.lit(value)) & (key >= F.lit(id_))), F.lit(True))
