"""Trailing-window aggregates with pandas ``rolling(n)`` semantics, O(1) per row.

Spark evaluates a sliding ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``
frame by re-aggregating the whole frame for every row (O(n) per row). For
the advanced set that dominates the job, so:

* **valid count** in the frame = running count of non-null inputs minus its
  value ``n`` rows earlier (exact integers);
* **sum / mean** with ``n >= LONG``: rows are cut into blocks of
  ``B = 2^k >= n`` rows (of the global row number; the smallest block size
  the series plan already uses). A running sum restarted
  at every block start gives ``P``; the frame sum is ``P(t) - P(t-n)`` when
  the frame stays inside the block, else ``P(t) + (P_end(prev block) -
  P(t-n))``. Every operand is a sum of at most ``B`` inputs, so the rounding
  error stays that of a short direct sum -- unlike one running sum over the
  whole series, whose differences cancel catastrophically.
* **max / min** with ``n >= LONG``: every block of ``B = 2^k <= n`` rows has the
  extreme from its start up to each row (prefix) and from each row up to its
  end (suffix, the same running extreme in the reverse order). The ``B`` rows up
  to t reach into two blocks: the suffix at ``t-B+1`` and the prefix at
  t. The frame is covered by at most ``MAX_PIECES`` such stretches.
* **stddev** with ``n >= LONG``: count, mean and squared deviations of the same
  prefixes and suffixes; a frame of ``B < n < 2B`` rows is a suffix, at most one
  whole block and a prefix, merged pairwise around the prefix's mean. Nothing
  is subtracted from a larger sum, so a large level costs no digits.
* shorter frames keep Spark's sliding frame: re-adding a dozen values costs less
  than the reverse order; their "n values present" test uses the O(1) count.

The forward block windows nest inside the series ordering of
:class:`barsmith.functions.ema.EmaPlan`, so they need no extra sort; the
suffixes need one (before it, in the pass of :func:`rolling_pass0`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .ema import BEFORE, EXPONENT_MENU, RUNNING, EmaPlan, block_col, offset
from .windows import CHUNK, RN

LONG = 16
#: Stretches of a block's length that cover a frame of an extreme, at most.
MAX_PIECES = 8

_AGG = {"sum": "sum", "avg": "avg", "stddev": "stddev_samp", "max": "max", "min": "min"}


@dataclass(frozen=True)
class Roll:
    out: str
    kind: str  # sum | avg | stddev | max | min
    src: str   # input column
    n: int

    @property
    def fast(self) -> bool:
        return self.kind in ("sum", "avg") and self.n >= LONG

    @property
    def extreme(self) -> bool:
        return self.kind in ("max", "min") and self.n >= LONG

    @property
    def spread(self) -> bool:
        return self.kind == "stddev" and self.n >= LONG

    @property
    def edges(self) -> bool:
        """Whether it is put together from prefixes and suffixes of blocks."""
        return self.extreme or self.spread


def _edge_exponents(rolls: list[Roll]) -> dict[Roll, int]:
    """Block exponent of every prefix/suffix roll; extremes share one that a deviation has."""
    ks = {r: r.n.bit_length() - 1 for r in rolls if r.edges}
    for r in rolls:
        if r.extreme:
            shared = [k for k in ks.values() if (1 << k) <= r.n <= MAX_PIECES << k]
            ks[r] = min(shared, default=ks[r])
    return ks


def rolling_plan(plan: EmaPlan, rolls: list[Roll]) -> EmaPlan:
    """``plan`` with the block sizes that ``rolls`` need besides."""
    ks = set(plan.exponents) | set(_edge_exponents(rolls).values())
    sums = [r.n for r in rolls if r.fast]
    if sums and (1 << max(plan.exponents, default=0)) < max(sums):
        ks.add(min(k for k in EXPONENT_MENU if (1 << k) >= max(sums)))
    return EmaPlan(plan.key, tuple(sorted(ks, reverse=True)))


def rolling_lookback(rolls: list[Roll]) -> int:
    """Rows before a row that its values read, the row before the frame included."""
    return max([r.n for r in rolls], default=0)


def _k(plan: EmaPlan, n: int) -> int:
    """Smallest block exponent of the plan with 2^k >= n."""
    ks = [k for k in plan.exponents if (1 << k) >= n]
    if not ks:
        raise ValueError(f"plan {plan.exponents} has no block of at least {n} rows")
    return min(ks)


def _edge_parts(rolls: list[Roll]) -> dict[tuple[str, str, int], list[str]]:
    """(kind, input, exponent) -> the aggregates whose prefixes and suffixes are needed."""
    parts = {}
    for r, k in _edge_exponents(rolls).items():
        parts[r.kind, r.src, k] = [r.kind] if r.extreme else ["avg", "var_pop"]
    return parts


def _edge_columns(rolls: list[Roll], side: str, over) -> list[str]:
    return [f"{agg}(`{src}`) {over(k)} AS `_r{side}_{agg}_{src}_{k}`"
            for (_, src, k), aggs in sorted(_edge_parts(rolls).items()) for agg in aggs]


def rolling_pass0(rolls: list[Roll], plan: EmaPlan) -> list[str]:
    """Suffixes: running aggregates of every block from its end (SQL expressions)."""
    def reverse(k: int) -> str:
        return f"OVER (PARTITION BY `{plan.key}`, {CHUNK}, {block_col(k)} ORDER BY {RN} DESC {RUNNING})"
    return _edge_columns(rolls, "s", reverse)


def rolling_pass1(rolls: list[Roll], plan: EmaPlan) -> list[str]:
    """Running valid counts per input, block-local prefix sums and prefixes (SQL expressions)."""
    srcs = sorted({r.src for r in rolls})
    prefixes = sorted({(r.src, _k(plan, r.n)) for r in rolls if r.fast})
    cols = [f"sum(CASE WHEN `{s}` IS NULL THEN 0 ELSE 1 END) {plan.over(RUNNING)} AS `_rc_{s}`"
            for s in srcs]
    cols += [f"sum(coalesce(`{s}`, 0)) {plan.over(RUNNING, k)} AS `_rp_{s}_{k}`" for s, k in prefixes]
    return cols + _edge_columns(rolls, "x", lambda k: plan.over(RUNNING, k))


def _starts(r: Roll, k: int) -> list[int]:
    """How many rows back the stretches of 2^k rows that cover the frame end."""
    size = 1 << k
    return sorted({*range(0, r.n - size + 1, size), r.n - size})


def _lagged(r: Roll, k: int) -> set[tuple[str, int]]:
    """(column, rows back) of the prefixes and suffixes that a roll reads."""
    size = 1 << k
    if r.extreme:
        name = f"{r.kind}_{r.src}_{k}"
        return {x for d in _starts(r, k) for x in ((f"_rs_{name}", d + size - 1), (f"_rx_{name}", d))}
    return {(f"_rs_{agg}_{r.src}_{k}", r.n - 1) for agg in ("avg", "var_pop")}


def _lag_name(column: str, back: int) -> str:
    return f"`_rl{column}_{back}`" if back else f"`{column}`"


def rolling_pass2(rolls: list[Roll], plan: EmaPlan) -> list[str]:
    """Lagged counts, prefixes and suffixes, previous block ends, short sliding frames (SQL expressions)."""
    cols = [f"lag(`_rc_{s}`, {n}) {plan.over()} AS `_rl_{s}_{n}`"
            for s, n in sorted({(r.src, r.n) for r in rolls})]
    for s, k in sorted({(r.src, _k(plan, r.n)) for r in rolls if r.fast}):
        end = (1 << k) - 1
        cols.append(f"last(CASE WHEN {offset(k)} = {end} THEN `_rp_{s}_{k}` END, true) "
                    f"{plan.over(BEFORE)} AS `_re_{s}_{k}`")
    cols += [f"lag(`_rp_{s}_{_k(plan, n)}`, {n}) {plan.over()} AS `_rq_{s}_{n}`"
             for s, n in sorted({(r.src, r.n) for r in rolls if r.fast})]
    edges = _edge_exponents(rolls)
    lags = {x for r, k in edges.items() for x in _lagged(r, k) if x[1]}
    cols += [f"lag(`{c}`, {back}) {plan.over()} AS {_lag_name(c, back)}" for c, back in sorted(lags)]
    for s, k in sorted({(r.src, k) for r, k in edges.items() if r.spread}):
        cols += [f"last(CASE WHEN {offset(k)} = {(1 << k) - 1} THEN `_rx_{agg}_{s}_{k}` END, true) "
                 f"{plan.over(BEFORE)} AS `_rb_{agg}_{s}_{k}`" for agg in ("avg", "var_pop")]
    cols += [f"{_AGG[r.kind]}(`{r.src}`) {plan.over(f'ROWS BETWEEN {r.n - 1} PRECEDING AND CURRENT ROW')} "
             f"AS `_rf_{r.out}`" for r in rolls if not (r.fast or r.edges)]
    return cols


def _extreme(r: Roll, k: int) -> str:
    pick = "greatest" if r.kind == "max" else "least"
    return f"{pick}({', '.join(_lag_name(c, back) for c, back in sorted(_lagged(r, k)))})"


def _deviation(r: Roll, k: int) -> str:
    """Sample deviation of a suffix, at most one whole block and a prefix, merged around the prefix's mean."""
    size = 1 << k
    head = {a: _lag_name(f"_rs_{a}_{r.src}_{k}", r.n - 1) for a in ("avg", "var_pop")}
    body = {a: f"`_rb_{a}_{r.src}_{k}`" for a in ("avg", "var_pop")}
    tail = {a: f"`_rx_{a}_{r.src}_{k}`" for a in ("avg", "var_pop")}
    n_tail = f"({offset(k)} + 1)"
    n_head = f"({size} - (({RN} - {r.n - 1}) & {size - 1}))"
    n_body = f"({r.n} - {n_tail} - {n_head})"
    at_head, at_body = f"({head['avg']} - {tail['avg']})", f"({body['avg']} - {tail['avg']})"
    centre = f"(({n_head} * {at_head} + CASE WHEN {n_body} > 0 THEN {n_body} * {at_body} ELSE 0D END) / {r.n}D)"
    squares = (f"({n_head} * ({head['var_pop']} + pow({at_head} - {centre}, 2)) "
               f"+ CASE WHEN {n_body} > 0 THEN {n_body} * ({body['var_pop']} + pow({at_body} - {centre}, 2)) ELSE 0D END "
               f"+ {n_tail} * ({tail['var_pop']} + pow({centre}, 2)))")
    # A frame of just one block is its prefix.
    return (f"sqrt(CASE WHEN {n_body} < 0 THEN {r.n} * {tail['var_pop']} ELSE {squares} END / {r.n - 1}D)")


def rolling_final(rolls: list[Roll], plan: EmaPlan) -> list[str]:
    """The rolled values, NULL until ``n`` non-null inputs are in the frame (SQL expressions)."""
    outs, edges = [], _edge_exponents(rolls)
    for r in rolls:
        ok = f"{RN} >= {r.n - 1} AND `_rc_{r.src}` - coalesce(`_rl_{r.src}_{r.n}`, 0) = {r.n}"
        if r.fast:
            k = _k(plan, r.n)
            p, lagged, end = f"`_rp_{r.src}_{k}`", f"`_rq_{r.src}_{r.n}`", f"`_re_{r.src}_{k}`"
            total = (f"(CASE WHEN {RN} < {r.n} THEN {p} WHEN {offset(k)} >= {r.n} THEN {p} - {lagged} "
                     f"ELSE {p} + ({end} - {lagged}) END)")
            value = total if r.kind == "sum" else f"{total} / {r.n}D"
        elif r.edges:
            value = (_extreme if r.extreme else _deviation)(r, edges[r])
        else:
            value = f"`_rf_{r.out}`"
        outs.append(f"CASE WHEN {ok} THEN {value} END AS `{r.out}`")
    return outs


_HELPERS = ("_rc_", "_rp_", "_rl_", "_re_", "_rq_", "_rf_", "_rs_", "_rx_", "_rb_")


def drop_rolling_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_HELPERS)])


def add_rolling(df: DataFrame, rolls: list[Roll], plan: EmaPlan) -> DataFrame:
    """Add one column per :class:`Roll`.

    ``df`` carries the segment columns and the plan's block columns; block
    sizes that only the rolls need are added here.
    """
    plan = rolling_plan(plan, rolls)
    df = plan.add_blocks(df)
    if any(r.edges for r in rolls):
        df = df.selectExpr("*", *rolling_pass0(rolls, plan))
    df = df.selectExpr("*", *rolling_pass1(rolls, plan))
    df = df.selectExpr("*", *rolling_pass2(rolls, plan))
    df = df.selectExpr("*", *rolling_final(rolls, plan))
    return drop_rolling_helpers(df)
