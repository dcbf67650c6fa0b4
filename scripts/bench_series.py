"""Time the feature sets on long series made from the driver's tables (not a registered query).

    python scripts/bench_series.py [bars] [symbols] [cpus]

The daily bars of ``orders`` are laid one after the other, a minute apart, as often as
it takes: ``bars`` rows of ``symbols`` series. Prints one JSON line: seconds of
every set (no-op sink, best of two) and of rolling maxima of growing frames.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from barsmith.functions.ema import EmaPlan  # noqa: E402
from barsmith.functions.rolling import Roll, add_rolling, rolling_lookback  # noqa: E402
from barsmith.functions.windows import DEFAULT_LAYOUT, finish, segment  # noqa: E402
from barsmith.operators import advanced, clean, daily, local  # noqa: E402
from barsmith.plans.fixtures import bars_orders  # noqa: E402
from barsmith.plans.tables import bar_table  # noqa: E402
from barsmith.session import get_session  # noqa: E402


def long_series(spark, n: int, symbols: int):
    bars = bar_table(bars_orders(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")))
    own = bars.count()
    numbered = bars.select("*", F.monotonically_increasing_id().alias("i"))
    copies = numbered.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(-(-n // own) - 1))))
    order = F.xxhash64("copy", "i")
    return bar_table(copies.select(
        F.pmod(order, F.lit(symbols)).cast("string").alias("symbol"),
        F.timestamp_seconds((F.col("copy") * own + F.pmod(F.col("i"), F.lit(1 << 33)) + F.shiftright("i", 33) * 1500) * 60).alias("date"),
        "open", "high", "low", "close", "volume").limit(n))


def rolled(bars, n: int):
    rolls = [Roll("top", "max", "high", n), Roll("low_", "min", "low", n), Roll("dev", "stddev", "close", n)]
    s = segment(bars, rolling_lookback(rolls))
    return finish(add_rolling(s, rolls, EmaPlan(DEFAULT_LAYOUT.key, ())))


def main() -> None:
    n, symbols, cpus = (int(x) for x in (sys.argv[1:] + ["240000", "100", "8"][len(sys.argv) - 1:]))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, extra={"spark.driver.memory": "16g"})
    bars = long_series(spark, n, symbols)
    sets = {
        "daily": lambda: daily.daily_features(bars),
        "local": lambda: local.local_features(bars),
        "adv_all": lambda: advanced.advanced_features(bars),
        "adv_rsi": lambda: advanced.advanced_features(bars, columns=advanced.FAMILIES["rsi"]),
        "adv_support_resistance": lambda: advanced.advanced_features(bars, columns=advanced.FAMILIES["support_resistance"]),
        "prep_features": lambda: clean.prep_features(bars),
        "zscore": lambda: clean.zscore(bars, "close"),
        "forward_fill": lambda: clean.forward_fill(bars, ["close"]),
        **{f"rolling_{w}": (lambda w=w: rolled(bars, w)) for w in (20, 50, 200, 800)},
    }
    out = {}
    for name, make in sets.items():
        times = []
        for _ in range(2):
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        out[name] = round(min(times), 2)
    print(json.dumps({"bars": n, "symbols": symbols, "cpus": cpus, "seconds": out}))


if __name__ == "__main__":
    main()
