"""Column expressions over prices, symbols and times. All stay in generated code."""

from pyspark.sql import functions as F

from tickloom.schemas import FRAMES, PRICE_COLUMNS


def sanitize_symbol(col, upper=True):
    """Drop non-word characters: ``eur/usd`` -> ``EURUSD``."""
    word = F.regexp_replace(col, r"\W", "")
    return F.upper(word) if upper else word


def fixed_text(col, places=5):
    """Fixed-decimal text, rounded on the exact binary value and without separators."""
    return F.call_function("format_number", F.col(col) if isinstance(col, str) else col,
                           F.lit("0." + "0" * places))


def fixed_round(col, places=5):
    """Round to `places` decimals on the exact binary value."""
    return fixed_text(col, places).cast("double")


def price_text(df, columns=PRICE_COLUMNS):
    """Give every price column present five-decimal text. A row that carries a value which
    is not a number in one of them is emptied: all its columns become null."""
    present = [c for c in df.columns if c in columns]
    textual = [c for c in present if dict(df.dtypes)[c] == "string"]
    number = {c: F.expr(f"try_cast(`{c}` AS double)") if c in textual else F.col(c) for c in present}
    shown = [fixed_text(number[c]).alias(c) if c in number else F.col(c) for c in df.columns]
    if not textual:
        return df.select(*shown)
    good = F.lit(True)
    for c in textual:
        good = good & (F.col(c).isNull() | number[c].isNotNull())
    return df.select(*[F.when(good, s).alias(c) for s, c in zip(shown, df.columns)])


def mid(bid, ask):
    return (F.col(bid) + F.col(ask)) / 2


def to_seconds(col):
    """Epoch milliseconds to whole seconds, rounded down."""
    return F.expr(f"(`{col}` - pmod(`{col}`, 1000)) div 1000")


def event_time(col):
    """Epoch seconds to a timestamp."""
    return F.timestamp_seconds(F.col(col) if isinstance(col, str) else col)


def epoch_millis(col):
    """Epoch milliseconds of a zoneless timestamp read as UTC, whatever the session zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")


def candle_end(seconds, width):
    """End of the candle that holds a second; a tick on a boundary opens the next candle."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return seconds - seconds % width + width


def frame_seconds(frame="frame", frames=None):
    """Length of a frame in seconds as an expression over the fixed frame table; an
    unknown frame gives null."""
    table = iter((frames or FRAMES).items())
    name, width = next(table)
    out = F.when(F.col(frame) == name, F.lit(width))
    for name, width in table:
        out = out.when(F.col(frame) == name, F.lit(width))
    return out.cast("long")


def time_label(col):
    """``HH:mm`` in UTC from epoch seconds."""
    minute = F.floor(F.col(col) / 60)
    return F.format_string("%02d:%02d", F.floor(minute / 60) % 24, minute % 60)


def tail(col, n):
    """The last n elements of an array, or all of them when it is shorter."""
    return F.slice(col, F.greatest(F.size(col) - (n - 1), F.lit(1)), n)
