"""Predictors of the next window's count, each from earlier windows only.

A series is one row per window. Run naively, ``over (order by window)`` would
move the whole series into one task. Here it is cut into blocks of consecutive
windows: running sums inside the blocks are parallel. A block's summary is a map from the
state before it to the state behind it. Such maps compose, so the summaries of a
thousand neighbouring blocks are put together to one, those again, and so on; each level hands
the state before a group down to its members, and joining it back to the windows completes the
sums. No task orders more than a thousand summaries a century at the top and a thousand anywhere else.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillcast.functions.time import scale_window, window_seconds

# Names of the predictors in results.
AVERAGE = "AVG"
REGRESSION = "SIMPLEREGRESSION"
TRACKING = "REINFORCEMENT"
TYPES = (AVERAGE, REGRESSION, TRACKING)


def block_length(step: float) -> int:
    """Windows per block: (1 - step)^-length has to stay far below the largest double."""
    return min(1024, math.floor(500 / -math.log1p(-step)))


#: Blocks of a group, groups of a group of groups and so on.
FAN = 1024
_CENTURY = 100 * 365 * 86_400


def levels_above(window: str, length: int, fan: int = FAN) -> int:
    """How often blocks are grouped until a century's are at most ``fan``."""
    blocks = _CENTURY / (window_seconds(window) * length)
    return max(0, math.ceil(math.log(max(blocks, 1), fan)) - 1)


def predict(
    series: DataFrame,
    window: str = "1 minute",
    history: int = 5,
    step: float = 0.1,
    series_key: str | None = None,
    types: Iterable[str] = TYPES,
) -> DataFrame:
    """Predictions for ``window_start, cnt``: one row per window and predictor.

    ``AVG`` is the mean of the last ``history`` counts, ``SIMPLEREGRESSION`` the
    least-squares line through the origin over epoch milliseconds (0 until two
    windows are known), ``REINFORCEMENT`` moves by ``step`` towards each count.
    ``window`` is the length of one window of the series. Only what the asked-for
    ``types`` need is computed.
    """
    return _Blocks(series, window, history, step, series_key).predictions(tuple(types))


def advance(
    series: DataFrame,
    before: DataFrame | None,
    window: str = "1 minute",
    history: int = 5,
    step: float = 0.1,
    series_key: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Predictions for the next windows of a series, and what to carry on from there.

    ``before`` is what the previous call carried: one row per key (``n, xy, xx, v,
    recent``); None at the beginning.
    """
    blocks = _Blocks(series, window, history, step, series_key, before)
    return blocks.predictions(TYPES), blocks.state()


class _Blocks:
    """A series cut into blocks, with the running sums of its predictors."""

    def __init__(
        self,
        series: DataFrame,
        window: str,
        history: int,
        step: float,
        series_key: str | None,
        before: DataFrame | None = None,
    ):
        if not 0 < step < 1:
            raise ValueError("step lies between 0 and 1")
        self.keys = [series_key] if series_key else []
        self.history, self.step, self.keep, self.before = history, step, 1.0 - step, before
        length = block_length(step)
        block = F.window("window_start", scale_window(window, length))["start"]
        self.levels = levels_above(window, length, FAN)
        self.block_ms = int(window_seconds(window) * length * 1000)
        in_block = Window.partitionBy(*self.keys, "block").orderBy("window_start")
        earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
        weight = F.when(F.col("i") < length, F.pow(F.lit(self.keep), -F.col("i"))).otherwise(
            F.raise_error(F.lit(f"the series has more than one row per {window} and key"))
        )
        grown = F.sum(F.col("cnt") * weight).over(earlier)
        self.rows = (
            series.withColumns(
                {
                    # Never NULL: the join below would otherwise filter one side's scan for
                    # it, and the two sides would no longer share their common stages.
                    "block": F.coalesce(F.unix_millis(block), F.lit(0)),
                    "x": F.unix_millis("window_start").cast("double"),
                }
            )
            .withColumn("i", F.row_number().over(in_block) - 1)
            .withColumns(
                {
                    "xy": _or_zero(F.sum(F.col("x") * F.col("cnt")).over(earlier)),
                    "xx": _or_zero(F.sum(F.col("x") * F.col("x")).over(earlier)),
                    "v": step * F.pow(F.lit(self.keep), F.col("i") - 1) * _or_zero(grown),
                    "recent": F.collect_list("cnt").over(in_block.rowsBetween(-history, -1)),
                }
            )
        )

    def _parts(self, types: tuple[str, ...]) -> dict[str, Column]:
        """A block's summary behind its last window, as far as the predictors need it.

        As a map: ``v`` before becomes ``keep``^n times that plus the block's own ``v``.
        """
        parts = {"n": (F.col("i") + 1).cast("bigint")}
        if REGRESSION in types:
            parts["xy"] = F.col("xy") + F.col("x") * F.col("cnt")
            parts["xx"] = F.col("xx") + F.col("x") * F.col("x")
        if TRACKING in types:
            parts["v"] = self.keep * F.col("v") + self.step * F.col("cnt")
        if AVERAGE in types:
            parts["recent"] = _last(F.concat("recent", F.array("cnt")), self.history).cast("array<bigint>")
        return parts

    def _composed(self, listed: Column, names: list[str]) -> Column:
        """The summary of neighbouring summaries, in their order."""
        nothing = {"n": F.lit(0).cast("bigint"), "xy": F.lit(0.0), "xx": F.lit(0.0), "v": F.lit(0.0), "recent": F.array().cast("array<bigint>")}
        then = {
            "n": lambda s, b: s["n"] + b["n"],
            "xy": lambda s, b: s["xy"] + b["xy"],
            "xx": lambda s, b: s["xx"] + b["xx"],
            "v": lambda s, b: F.pow(F.lit(self.keep), b["n"]) * s["v"] + b["v"],
            "recent": lambda s, b: _last(F.concat(s["recent"], b["recent"]), self.history),
        }
        zero = F.struct(*[nothing[name].alias(name) for name in names])
        return F.aggregate(listed, zero, lambda s, b: F.struct(*[then[name](s, b).alias(name) for name in names]))

    def _before(self, cells: DataFrame, names: list[str], levels: int) -> DataFrame:
        """``cells`` (keys, ``at``, summary ``b``) with the summary ``p`` of all that lies before each."""
        group = _floor(F.col("at"), FAN) if levels else F.lit(0)
        cells = cells.withColumn("group", group)
        earlier = Window.partitionBy(*self.keys, "group").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        inside = cells.withColumn("p", self._composed(F.collect_list("b").over(earlier), names))
        if not levels:
            return inside.drop("group")
        listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "b"))), lambda cell: cell["b"])
        groups = cells.groupBy(*self.keys, F.col("group").alias("at")).agg(self._composed(listed, names).alias("b"))
        above = self._before(groups, names, levels - 1).select(*self.keys, F.col("at").alias("group"), F.col("p").alias("above"))
        joined = inside.join(above, [*self.keys, "group"])
        return joined.withColumn("p", self._composed(F.array("above", "p"), names)).drop("above", "group")

    def _carried(self, types: tuple[str, ...]) -> DataFrame:
        """Per block its summary ``b`` and the state of all that lies before it."""
        parts = [value.alias(name) for name, value in self._parts(types).items()]
        names = list(self._parts(types))
        blocks = self.rows.groupBy(*self.keys, "block").agg(
            F.max_by(F.struct(*parts), "window_start").alias("b")
        )
        cells = blocks.withColumn("at", _floor(F.col("block"), self.block_ms))
        found = self._before(cells, names, self.levels)
        carried = found.select(*self.keys, "block", "b", *[F.col(f"p.{name}").alias(f"{name}0") for name in names])
        if self.before is None:
            return carried
        old = F.struct(*[F.col(name) for name in ("n", "xy", "xx", "v", "recent")]).alias("old")
        if self.keys:
            joined = carried.join(self.before.select(*self.keys, old), self.keys, "left")
        else:
            # One row of a few numbers; as values they need no join.
            row = self.before.first()
            values = [F.lit(row[name]).alias(name) for name in ("n", "xy", "xx", "v")] if row else []
            known = F.struct(*values, F.array(*map(F.lit, row["recent"])).cast("array<bigint>").alias("recent")) if row else None
            kind = "struct<n:bigint,xy:double,xx:double,v:double,recent:array<bigint>>"
            joined = carried.withColumn("old", known if row else F.lit(None).cast(kind))
        empty = F.array().cast("array<bigint>")
        return joined.withColumns(
            {
                "v0": F.pow(F.lit(self.keep), F.col("n0")) * _or_zero(F.col("old.v")) + F.col("v0"),
                "n0": F.coalesce("old.n", F.lit(0)) + F.col("n0"),
                "xy0": _or_zero(F.col("old.xy")) + F.col("xy0"),
                "xx0": _or_zero(F.col("old.xx")) + F.col("xx0"),
                "recent0": _last(F.concat(F.coalesce("old.recent", empty), "recent0"), self.history),
            }
        ).drop("old")

    def predictions(self, types: tuple[str, ...]) -> DataFrame:
        values = {}
        if AVERAGE in types:
            recent = _last(F.concat("recent0", "recent"), self.history)
            total = F.aggregate(recent, F.lit(0).cast("bigint"), lambda s, c: s + c)
            values[AVERAGE] = F.when(F.size(recent) > 0, total / F.size(recent)).otherwise(0.0)
        if REGRESSION in types:
            xx = F.col("xx0") + F.col("xx")
            values[REGRESSION] = F.when(
                (F.col("n0") + F.col("i") >= 2) & (xx > 0),
                F.col("x") * (F.col("xy0") + F.col("xy")) / xx,
            ).otherwise(0.0)
        if TRACKING in types:
            values[TRACKING] = F.pow(F.lit(self.keep), F.col("i")) * F.col("v0") + F.col("v")
        listed = F.array(
            *[
                F.struct(F.lit(name).alias("prediction_type"), value.alias("prediction"))
                for name, value in values.items()
            ]
        )
        return (
            self.rows.join(self._carried(types).drop("b"), [*self.keys, "block"])
            .select(*self.keys, "window_start", "cnt", F.inline(listed))
            .withColumn("deviation", F.col("cnt") - F.col("prediction"))
            .select(*self.keys, "prediction_type", "window_start", "cnt", "prediction", "deviation")
        )

    def state(self) -> DataFrame:
        """One row per key: the state behind the last window, of keys without new ones as it was."""
        names = ("n", "xy", "xx", "v", "recent")
        values = {
            "n": F.col("n0") + F.col("b.n"),
            "xy": F.col("xy0") + F.col("b.xy"),
            "xx": F.col("xx0") + F.col("b.xx"),
            "v": F.pow(F.lit(self.keep), F.col("b.n")) * F.col("v0") + F.col("b.v"),
            "recent": _last(F.concat("recent0", "b.recent"), self.history),
        }
        last = self._carried(TYPES).select(
            *self.keys, "block", F.struct(*[value.alias(name) for name, value in values.items()]).alias("s")
        )
        new = last.groupBy(*self.keys).agg(F.max_by("s", "block").alias("s")).where("s is not null")
        new = new.select(*self.keys, *[F.col(f"s.{name}") for name in names])
        if self.before is None:
            return new
        if self.keys:
            return new.union(self.before.join(new, self.keys, "left_anti").select(*new.columns))
        # Without a key both sides are one row at most; the one that has seen more windows counts.
        both = new.union(self.before.select(*new.columns))
        return both.agg(F.max_by(F.struct(*names), "n").alias("s")).where("s is not null").select("s.*")


def only(predictions: DataFrame, prediction_type: str) -> DataFrame:
    """One predictor's rows without the type column, as its result file holds them."""
    return predictions.filter(F.col("prediction_type") == prediction_type).drop("prediction_type")


def _floor(at: Column, size: int) -> Column:
    # Never NULL, for the same reason as a block.
    return F.coalesce(F.floor(at / size).cast("bigint"), F.lit(0))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _last(items: Column, count: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - count, F.lit(0)) + 1, count)
