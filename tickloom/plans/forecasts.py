"""Queries over model input and forecasts."""

from pyspark.sql import functions as F

from tickloom.operators import features as X
from tickloom.operators import indicators as I
from tickloom.operators import recurrent as R
from tickloom.plans import tables as T
from tickloom.plans.registry import query
from tickloom.plans.series import SQL_IND, bars
from tickloom.schemas import FEATURES
from tickloom.session import fresh_dir

# Demonstration model: it looks at the close and the open of the newest block row.
WEIGHTS = [0.0] * 90 + [0.3, 0.0, 0.0, 0.7] + [0.0] * 6
MODEL = X.linear_model(WEIGHTS)

SQL_FEATURES = ", ".join(f'"{c}"' for c in FEATURES)
SQL_POINTS = ", ".join(
    [f'("{c}" - mid) * 100000 AS "{c}"' for c in FEATURES[:6]]
    + [f'"{c}" * 100000 AS "{c}"' for c in FEATURES[6:9]] + ["rsi"])
# One row per block row: `ts` is the newest candle, the block ends one row before it.
SQL_BLOCKS = f"""{SQL_IND},
block_rows AS (
  SELECT e.symbol, e.frame, e.ts AS newest, r.ts, r.rn - e.rn AS step, {", ".join("r." + c for c in SQL_FEATURES.split(", "))},
         last((r."closeBid" + r."openBid") / 2 ORDER BY r.rn) OVER (PARTITION BY e.symbol, e.frame, e.ts) AS mid
  FROM indicators e JOIN indicators r
    ON e.symbol = r.symbol AND e.frame = r.frame AND r.rn BETWEEN e.rn - 10 AND e.rn - 1
  WHERE e.rn >= 61),
points AS (SELECT symbol, frame, newest, ts, step, mid, {SQL_POINTS} FROM block_rows)""".replace(
    'last((r."closeBid" + r."openBid") / 2 ORDER BY r.rn) OVER (PARTITION BY e.symbol, e.frame, e.ts)',
    'first_value((r."closeBid" + r."openBid") / 2) OVER (PARTITION BY e.symbol, e.frame, e.ts ORDER BY r.rn DESC)')
SQL_NEWEST = """QUALIFY newest = max(newest) OVER (PARTITION BY symbol, frame)"""
SQL_FORECAST = """CAST(printf('%.5f', mid + round_even(diff, 0) / 100000) AS DOUBLE)"""


@query("feature_columns", f"""WITH {SQL_IND} SELECT symbol, frame, ts, {T.SQL_OHLC.split(', ')[0]},
  "highBid", "lowBid", "closeBid", {T.six('bbupper', 'bbupper')}, {T.six('bblower', 'bblower')},
  {T.six('body', 'body')}, {T.six('up', 'up')}, {T.six('down', 'down')}, {T.six('rsi', 'rsi')} FROM indicators""")
def feature_columns(spark, sf):
    return T.shown(X.feature_columns(I.indicators(bars(spark, sf))), FEATURES[4:])


@query("last_block", f"""WITH {SQL_IND} SELECT symbol, frame, ts, "closeBid", {T.six('rsi', 'rsi')} FROM indicators
QUALIFY row_number() OVER (PARTITION BY symbol, frame ORDER BY ts DESC) BETWEEN 2 AND 11""")
def last_block(spark, sf):
    rows = X.last_block(I.indicators(bars(spark, sf)))
    return T.shown(rows.select("symbol", "frame", "ts", "closeBid", "rsi"), ["rsi"])


@query("normalize_block", f"""WITH {SQL_BLOCKS}
SELECT symbol, frame, ts, {T.six('mid', 'mid')}, {", ".join(T.six(c, c, 3) for c in SQL_FEATURES.split(", "))}
FROM points {SQL_NEWEST}""")
def normalize_block(spark, sf):
    rows = X.normalize_block(X.last_block(I.indicators(bars(spark, sf))))
    return T.shown(T.shown(rows, FEATURES, 3), ["mid"])


SQL_CELLS = " UNION ALL ".join(
    f'SELECT symbol, frame, newest, step, {i} AS col, "{c}" AS v FROM points' for i, c in enumerate(FEATURES))


def cells(blocks):
    """One row per matrix cell."""
    rows = blocks.select("symbol", "frame", "ts", F.posexplode("block").alias("step", "row"))
    return rows.select("symbol", "frame", "ts", "step", F.posexplode("row").alias("col", "v"))


@query("assemble", f"""WITH {SQL_BLOCKS}, cells AS ({SQL_CELLS})
SELECT symbol, frame, CAST(step + 10 AS BIGINT) AS step, CAST(col AS BIGINT) AS col, {T.six('v', 'v', 3)} FROM cells
{SQL_NEWEST}""")
def assemble(spark, sf):
    blocks = X.assemble(X.normalize_block(X.last_block(I.indicators(bars(spark, sf)))))
    flat = cells(blocks).select("symbol", "frame", F.col("step").cast("long").alias("step"),
                                F.col("col").cast("long").alias("col"), "v")
    return T.shown(flat, ["v"], 3)


@query("rolling_blocks", f"""WITH {SQL_BLOCKS}, cells AS ({SQL_CELLS})
SELECT symbol, frame, newest AS ts, count(*) AS n, {T.six('sum(v)', 'total', 2)},
       {T.six('sum(v * (step + 11))', 'by_step', 1)}, {T.six('sum(v * (col + 1))', 'by_column', 1)}
FROM cells GROUP BY symbol, frame, newest""")
def rolling_blocks(spark, sf):
    add = lambda acc, x: acc + x
    zero = F.lit(0.0)
    row_sums = F.transform("block", lambda r: F.aggregate(r, zero, add))
    by_step = F.aggregate(F.transform(row_sums, lambda s, i: s * (i + 1)), zero, add)
    by_column = F.aggregate(F.transform("block", lambda r: F.aggregate(
        F.transform(r, lambda x, i: x * (i + 1)), zero, add)), zero, add)
    blocks = X.rolling_blocks(bars(spark, sf))
    out = blocks.select("symbol", "frame", "ts", F.size(F.flatten("block")).cast("long").alias("n"),
                        F.aggregate(row_sums, zero, add).alias("total"), by_step.alias("by_step"),
                        by_column.alias("by_column"))
    return T.shown(T.shown(out, ["total"], 2), ["by_step", "by_column"], 1)


def _sql_stats(centre, spread):
    return f"""WITH {SQL_BLOCKS}, cells AS ({SQL_CELLS}),
stats AS (SELECT symbol, frame, col, {centre} AS centre, coalesce(nullif({spread}, 0), 1) AS spread
  FROM cells GROUP BY symbol, frame, col)"""


def _fitted(spark, sf, kind):
    stats = X.fit_scaler(X.rolling_blocks(bars(spark, sf)), kind)
    return (stats.select("symbol", "frame", F.posexplode(F.arrays_zip("centre", "spread")).alias("col", "s"))
            .select("symbol", "frame", F.col("col").cast("long").alias("col"), "s.centre", "s.spread"))


@query("fit_scaler", _sql_stats("avg(v)", "stddev_pop(v)") + f"""
SELECT symbol, frame, CAST(col AS BIGINT) AS col, {T.six('centre', 'centre', 2)}, {T.six('spread', 'spread', 2)}
FROM stats""")
def fit_scaler(spark, sf):
    return T.shown(_fitted(spark, sf, "standard"), ["centre", "spread"], 2)


@query("fit_scaler_minmax", _sql_stats("min(v)", "max(v) - min(v)") + f"""
SELECT symbol, frame, CAST(col AS BIGINT) AS col, {T.six('centre', 'centre', 3)}, {T.six('spread', 'spread', 3)}
FROM stats""")
def fit_scaler_minmax(spark, sf):
    return T.shown(_fitted(spark, sf, "minmax"), ["centre", "spread"], 3)


@query("scale", _sql_stats("avg(v)", "stddev_pop(v)") + f"""
SELECT c.symbol, c.frame, newest AS ts, {T.six('sum((v - centre) / spread)', 'scaled', 5)},
       {T.six('sum((v - centre) / spread * spread + centre)', 'back', 1)}
FROM cells c JOIN stats s ON c.symbol = s.symbol AND c.frame = s.frame AND c.col = s.col
GROUP BY c.symbol, c.frame, newest""")
def scale(spark, sf):
    blocks = X.rolling_blocks(bars(spark, sf))
    scaled = X.scale(blocks, X.fit_scaler(blocks))
    total = lambda c: F.aggregate(F.flatten(c), F.lit(0.0), lambda acc, x: acc + x)
    back = F.transform("block", lambda r: F.transform(
        r, lambda x, i: x * F.get("spread", i) + F.get("centre", i)))
    out = scaled.select("symbol", "frame", "ts", total("block").alias("scaled"), total(back).alias("back"))
    return T.shown(T.shown(out, ["scaled"], 5), ["back"], 1)


@query("score", f"""WITH {SQL_BLOCKS}
SELECT symbol, frame, newest AS ts, {T.six('0.7 * "closeBid" + 0.3 * "openBid"', '"out"', 3)}
FROM points WHERE step = -1""")
def score(spark, sf):
    scored = X.score(X.rolling_blocks(bars(spark, sf)), MODEL)
    return T.shown(scored.select("symbol", "frame", "ts", "out"), ["out"], 3)


@query("denormalize", f"""WITH {SQL_BLOCKS},
diffs AS (SELECT symbol, frame, newest AS ts, mid, 0.6 * body AS diff FROM points WHERE step = -1)
SELECT symbol, frame, ts, {SQL_FORECAST} AS prediction FROM diffs""")
def denormalize(spark, sf):
    last = F.element_at("block", -1)
    diffs = X.rolling_blocks(bars(spark, sf)).select("symbol", "frame", "ts", "mid", (0.6 * last[6]).alias("diff"))
    return X.denormalize(diffs).select("symbol", "frame", "ts", "prediction")


@query("prediction_rows", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, "closeBid" AS prediction, CAST(ts + seconds AS BIGINT) AS ts
FROM candles JOIN frames USING (frame)""")
def prediction_rows(spark, sf):
    return X.prediction_rows(T.all_candles(spark, sf).select("symbol", "frame", "ts", F.col("closeBid").alias("prediction")))


SQL_RAW_FORECAST = f"""WITH {SQL_BLOCKS},
diffs AS (SELECT symbol, frame, newest, mid, 0.7 * "closeBid" + 0.3 * "openBid" AS diff FROM points WHERE step = -1)
SELECT symbol, frame, {SQL_FORECAST} AS prediction, CAST(newest + seconds AS BIGINT) AS ts FROM diffs JOIN frames USING (frame)"""


@query("forecast", f"{SQL_RAW_FORECAST} {SQL_NEWEST}")
def forecast(spark, sf):
    return X.forecast(bars(spark, sf), MODEL)


@query("forecast_every", SQL_RAW_FORECAST)
def forecast_every(spark, sf):
    return X.forecast(bars(spark, sf), MODEL, every=True)


@query("forecast_scaled", _sql_stats("avg(v)", "stddev_pop(v)") + f""",
outs AS (
  SELECT p.symbol, p.frame, newest, mid,
         (0.7 * ("closeBid" - c.centre) / c.spread + 0.3 * ("openBid" - o.centre) / o.spread) * c.spread + c.centre AS diff
  FROM points p JOIN stats c ON p.symbol = c.symbol AND p.frame = c.frame AND c.col = 3
                JOIN stats o ON p.symbol = o.symbol AND p.frame = o.frame AND o.col = 0
  WHERE step = -1)
SELECT symbol, frame, {SQL_FORECAST} AS prediction, CAST(newest + seconds AS BIGINT) AS ts FROM outs JOIN frames USING (frame)""")
def forecast_scaled(spark, sf):
    candles = bars(spark, sf)
    return X.forecast(candles, MODEL, scaler=X.fit_scaler(X.rolling_blocks(candles)), every=True)


@query("forecast_line", f"""WITH {SQL_BLOCKS},
lasts AS (SELECT p.*, lead(i."closeBid") OVER (PARTITION BY p.symbol, p.frame ORDER BY newest) AS nxt
          FROM points p JOIN indicators i ON p.symbol = i.symbol AND p.frame = i.frame AND i.ts = p.newest WHERE step = -1),
line AS (SELECT regr_slope((nxt - mid) * 100000, body) AS slope, regr_intercept((nxt - mid) * 100000, body) AS start FROM lasts),
outs AS (SELECT symbol, frame, newest, mid, slope * body + start AS diff FROM lasts, line)
SELECT symbol, frame, {SQL_FORECAST} AS prediction, CAST(newest + seconds AS BIGINT) AS ts FROM outs JOIN frames USING (frame)""")
def forecast_line(spark, sf):
    """Forecasts by a line through the next close over the candle body before it, fitted to all blocks."""
    blocks, labelled = labelled_blocks(spark, sf)
    return X.forecast_blocks(blocks, X.fit_line(labelled, "label"))


def labelled_blocks(spark, sf):
    """All blocks, written once, and those with the close after their newest candle, in points over the mid."""
    candles, path = bars(spark, sf), fresh_dir(spark, "blocks")
    X.rolling_blocks(candles).write.parquet(path)
    blocks = spark.read.parquet(path)
    nxt = I.over_series(candles.select("symbol", "frame", "ts", "closeBid"), 1, lambda d, w: d.withColumn(
        "_at", F.lag("ts").over(w))).select("symbol", "frame", F.col("_at").alias("ts"), "closeBid")
    return blocks, blocks.join(nxt, ["symbol", "frame", "ts"]).withColumn("label", (F.col("closeBid") - F.col("mid")) * X.POINTS)


@query("forecast_fitted")
def forecast_fitted(spark, sf):
    """Forecasts of a model fitted to the next close of every block."""
    blocks, labelled = labelled_blocks(spark, sf)
    return X.forecast_blocks(blocks, X.fit_linear(labelled, "label"))


HIDDEN = 2
WEIGHT_COUNT = R.weight_count(HIDDEN)
#: Model weights that differ by series; in SQL they are the list `w`.
SQL_WEIGHTS = f"list_transform(range(1, {WEIGHT_COUNT + 1}), lambda k: 0.4 * sin(0.7 * k + length(symbol) + 2 * length(frame)))"


def series_weights(series):
    """A model for every series."""
    start = F.length("symbol") + 2 * F.length("frame")
    return series.select("symbol", "frame", F.transform(F.sequence(F.lit(1), F.lit(WEIGHT_COUNT)), lambda k: 0.4 * F.sin(0.7 * k + start)).alias("weights"))


def _sql_gate(j):
    """Weighted sum of gate unit `j` of the four times HIDDEN."""
    wide = 4 * HIDDEN
    given = " + ".join(f"v[{k + 1}] * w[{k * wide + j + 1}]" for k in range(len(FEATURES)))
    own = " + ".join(f"h[{k + 1}] * w[{(len(FEATURES) + k) * wide + j + 1}]" for k in range(HIDDEN))
    return f"{given} + {own} + w[{(len(FEATURES) + HIDDEN) * wide + j + 1}]"


def _sigmoid(z):
    return f"(1 / (1 + exp(-({z}))))"


_CELLS = ", ".join(f"{_sigmoid(_sql_gate(HIDDEN + k))} * c[{k + 1}] + {_sigmoid(_sql_gate(k))} * tanh({_sql_gate(3 * HIDDEN + k)})" for k in range(HIDDEN))
_OUTS = ", ".join(f"{_sigmoid(_sql_gate(2 * HIDDEN + k))}" for k in range(HIDDEN))
_SHOWN = ", ".join(f"o[{k + 1}] * tanh(n[{k + 1}])" for k in range(HIDDEN))
_BASE = WEIGHT_COUNT - HIDDEN - 1


@query("forecast_recurrent", _sql_stats("avg(v)", "stddev_pop(v)").replace("WITH ", "WITH RECURSIVE ", 1) + f""",
rows_ AS (
  SELECT c.symbol, c.frame, newest, step, list((v - centre) / spread ORDER BY c.col) AS v
  FROM cells c JOIN stats s ON c.symbol = s.symbol AND c.frame = s.frame AND c.col = s.col GROUP BY ALL),
run AS (
  SELECT symbol, frame, newest, -11 AS step, [{", ".join(["0.0::DOUBLE"] * HIDDEN)}] AS h, [{", ".join(["0.0::DOUBLE"] * HIDDEN)}] AS c, {SQL_WEIGHTS} AS w FROM points WHERE step = -1
  UNION ALL
  SELECT symbol, frame, newest, step, [{_SHOWN}] AS h, n AS c, w FROM (
    SELECT r.symbol, r.frame, r.newest, x.step, r.w, [{_CELLS}] AS n, [{_OUTS}] AS o
    FROM run r JOIN rows_ x ON r.symbol = x.symbol AND r.frame = x.frame AND r.newest = x.newest AND x.step = r.step + 1)),
outs AS (
  SELECT r.symbol, r.frame, r.newest, p.mid, ({" + ".join(f"h[{k + 1}] * w[{_BASE + k + 1}]" for k in range(HIDDEN))} + w[{WEIGHT_COUNT}]) * s.spread + s.centre AS diff
  FROM run r JOIN points p ON r.symbol = p.symbol AND r.frame = p.frame AND r.newest = p.newest AND p.step = -1
       JOIN stats s ON r.symbol = s.symbol AND r.frame = s.frame AND s.col = 3
  WHERE r.step = -1)
SELECT symbol, frame, {SQL_FORECAST} AS prediction, CAST(newest + seconds AS BIGINT) AS ts FROM outs JOIN frames USING (frame)""")
def forecast_recurrent(spark, sf):
    """Every candle's forecast by the recurrent model and the scaler of its own series, all frames."""
    blocks = X.rolling_blocks(bars(spark, sf))
    scaler = X.fit_scaler(blocks)
    return X.forecast_blocks(blocks, R.series_models(series_weights(scaler), HIDDEN), scaler)
