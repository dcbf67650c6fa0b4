"""Exponential moving average (pandas ``ewm(span=n).mean()``, ``adjust=True``)
as native window aggregates.

    EMA_t = sum_{i<=t} q^(t-i) x_i / sum_{i<=t} q^(t-i),  alpha = 2/(n+1), q = 1-alpha

Rows are cut into blocks of ``B = 2^k`` rows of the global row number, with
``q^B <= 1e-18`` so that history older than one block weighs nothing at
double precision. Within a block a running sum of ``x * q^-o`` (``o`` = offset
in the block) rebased by ``q^o`` gives the local part; the last local value of
the previous block, decayed by ``q^(o+1)``, carries the history. NULL inputs
add no weight but still decay older weights (pandas ``ignore_na=False``).

All block sizes are powers of two, so blocks of different spans nest. One
ordering ``(blk_kmax, ..., blk_kmin, rn)`` then serves every block window
*and* the ordinary feature windows: the whole feature set needs one sort.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import CHUNK, RN

NEGLIGIBLE = 1e-18
# Largest exponent the rebasing may reach: q^-(B-1) <= e^460 ~ 1e200.
MAX_LOG_GROWTH = 460.0
# Block sizes come from a short menu (2^k, k = 1 mod 3): every span has a
# feasible size in it, and spans share sizes, so a feature set needs few
# distinct block windows (each is one Window operator per pass).
EXPONENT_MENU = (1, 4, 7, 10, 13, 16, 19, 22)


def decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def block_exponent(span: int) -> int:
    """Largest menu exponent k with q^(2^k) <= 1e-18 and no overflow of q^-(2^k)."""
    rate = -math.log(decay(span))
    need = math.log(1.0 / NEGLIGIBLE) / rate
    ok = [k for k in EXPONENT_MENU if (1 << k) >= need and (1 << k) * rate <= MAX_LOG_GROWTH]
    if not ok:
        raise ValueError(f"no block size for span {span}")
    return max(ok)


def halo_rows(spans: list[int]) -> int:
    """Look-back rows a chunk needs so its first row sees a complete previous block."""
    return 2 * (1 << max(block_exponent(s) for s in spans)) if spans else 0


def block_col(k: int) -> str:
    return f"_blk{k}"


@dataclass(frozen=True)
class EmaPlan:
    key: str
    exponents: tuple[int, ...]  # descending

    @classmethod
    def for_spans(cls, key: str, spans: list[int], extra_exponents=()) -> "EmaPlan":
        exps = {block_exponent(s) for s in spans} | set(extra_exponents)
        return cls(key, tuple(sorted(exps, reverse=True)))

    def add_blocks(self, df: DataFrame) -> DataFrame:
        missing = [k for k in self.exponents if block_col(k) not in df.columns]
        return df.select("*", *[F.shiftright(F.col(RN), k).alias(block_col(k)) for k in missing])

    def over(self, frame: str = "", k: int | None = None) -> str:
        """SQL ``OVER (...)`` of the series window, or of block ``k``'s window."""
        i = -1 if k is None else self.exponents.index(k)
        part = [f"`{self.key}`", CHUNK] + [block_col(e) for e in self.exponents[: i + 1]]
        order = [block_col(e) for e in self.exponents[i + 1:]] + [RN]
        return f"OVER (PARTITION BY {', '.join(part)} ORDER BY {', '.join(order)} {frame})"


RUNNING = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def dbl(x: float) -> str:
    """A double literal that parses back to exactly ``x``."""
    return f"{float(x)!r}D"


def offset(k: int) -> str:
    """Position of the row within its block of 2^k rows."""
    return f"({RN} & {(1 << k) - 1})"


def ema_locals(specs: list[tuple[str, int, str]], plan: EmaPlan) -> list[str]:
    """Pass 1 (SQL expressions): block-local weighted sums (numerator, weight)."""
    cols = []
    for src, span, out in specs:
        q, k = dbl(decay(span)), block_exponent(span)
        o = offset(k)
        up, down = f"pow({q}, -{o})", f"pow({q}, {o})"
        over = plan.over(RUNNING, k)
        cols += [
            f"sum(coalesce(`{src}`, 0D) * {up}) {over} * {down} AS `_ema_{out}_n`",
            f"sum(CASE WHEN `{src}` IS NULL THEN 0D ELSE 1D END * {up}) {over} * {down} AS `_ema_{out}_d`",
        ]
    return cols


def ema_finish(specs: list[tuple[str, int, str]], plan: EmaPlan) -> list[str]:
    """Pass 2 (SQL expressions): add the decayed carry of the previous block."""
    cols = []
    for src, span, out in specs:
        q, k = dbl(decay(span)), block_exponent(span)
        o, end = offset(k), (1 << k) - 1
        fade = f"pow({q}, {o} + 1)"
        carry = {part: f"coalesce(last(CASE WHEN {o} = {end} THEN `_ema_{out}_{part}` END, true) "
                       f"{plan.over(BEFORE)}, 0D)" for part in ("n", "d")}
        cols.append(f"try_divide(`_ema_{out}_n` + {carry['n']} * {fade}, "
                    f"`_ema_{out}_d` + {carry['d']} * {fade}) AS `{out}`")
    return cols


def drop_ema_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_ema_")])


def add_emas(df: DataFrame, specs: list[tuple[str, int, str]], plan: EmaPlan) -> DataFrame:
    """Add ``out = EMA(src, span)`` for every ``(src, span, out)`` in ``specs``.

    ``df`` must carry the segment columns, ``_seg_rn`` and the plan's block
    columns (:meth:`EmaPlan.add_blocks`).
    """
    df = df.selectExpr("*", *ema_locals(specs, plan))
    df = df.selectExpr("*", *ema_finish(specs, plan))
    return drop_ema_helpers(df)


def ema_column(values: list[float | None], span: int) -> list[float | None]:
    """Plain-Python reference recurrence (tests and docs only)."""
    q = decay(span)
    num = den = 0.0
    out = []
    for v in values:
        num *= q
        den *= q
        if v is not None:
            num += v
            den += 1.0
        out.append(num / den if den else None)
    return out
