"""Which formats do the dates of a text column have, if nobody says?

Each value has a shape: runs of one or two digits are ``#``, longer ones keep their length,
names of months are ``MMM`` or ``MMMM``. Only shapes that can be dates are told apart, so
there are few, whatever the column holds. Values are counted by shape and by the orders of
year, month and day in which their numbers can be read; an order is proven by values that no
other one reads, such as days above 12.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of months, and what shapes of dates look like. Separators of a
# numeric date are the same; a time may follow a blank or a T.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
SHORT_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
TIME = r"(?:[ T]#:#(?::#(?:\.0{3}|\.0{6})?)?(?: ?a)?)?\z"
NUMERIC = rf"^(?:#([/.-])#\1(?:#|0000)|0000([/.-])#\2#){TIME}"
NAMED = rf"^(?:# M+ 0000|#-M+-(?:0000|#)|M+ #, ?0000){TIME}"
COMPACT = rf"^0{{8}}{TIME}"
LONGEST = 40
# Runs of digits of a date and its time: day, month, year, hour, minute, second, fraction.
RUNS = 7
# Orders by kind of shape; "dy" is the rest of a date whose month has a name.
ORDERS = {
    "year_last": ("Mdy", "dMy"),
    "short": ("Mdy", "dMy", "yMd"),
    "year_first": ("yMd", "ydM"),
    "compact": ("yMd",),
    "named": ("dy",),
}


def shape(text: Column) -> Column:
    """The shape of a value that can be a date, else NULL."""
    found = F.regexp_replace(text, rf"(?i)(?<![a-z])(?:{MONTHS})(?![a-z])", "MMMM")
    found = F.regexp_replace(found, rf"(?i)(?<![a-z])(?:{SHORT_MONTHS})(?![a-z])", "MMM")
    found = F.regexp_replace(found, r"(?i)(?<=[0-9 ])[ap]m\z", "a")
    found = F.regexp_replace(F.regexp_replace(found, "[0-9]", "0"), "(?<!0)00?(?!0)", "#")
    likely = (F.length(text) <= LONGEST) & text.rlike("^[0-9a-zA-Z]")
    return F.when(likely & (found.rlike(NUMERIC) | found.rlike(NAMED) | found.rlike(COMPACT)), found)


def _kind(shape: Column) -> Column:
    return (
        F.when(shape.contains("M"), "named")
        .when(shape.startswith("00000000"), "compact")
        .when(shape.startswith("0000"), "year_first")
        .when(shape.rlike("^#[/.-]#[/.-]0000"), "year_last")
        .when(shape.isNotNull(), "short")
    )


def _orders(kind: Column, prefer: str) -> Column:
    """The orders to try, the preferred one of month and day first."""
    found = F.array().cast("array<string>")
    for name, orders in ORDERS.items():
        liked = sorted(orders, key=lambda o: (o.index("d") < o.index("M")) != (prefer == "dMy") if "M" in o and o[0] != "y" else 0)
        found = F.when(kind == name, F.array(*map(F.lit, liked))).otherwise(found)
    return found


def _reads(order: str, runs: Column) -> Column:
    """Whether the numbers of a value can be month and day in an order."""
    month = F.get(runs, F.lit(order.index("M"))).cast("int").between(1, 12) if "M" in order else F.lit(True)
    return month & F.get(runs, F.lit(order.index("d"))).cast("int").between(1, 31)


def _with_pattern(df: DataFrame) -> DataFrame:
    """Adds the format of ``shape`` in ``order``: one letter where some number (``narrow``) has one digit only."""
    fixed = F.regexp_replace(F.regexp_replace("shape", r"\.0{6}", ".SSSSSS"), r"\.0{3}\b", ".SSS")
    fixed = F.regexp_replace(F.regexp_replace(fixed, "^0{8}", "yyyyMMdd"), "T", "'T'")
    fixed = F.regexp_replace(F.regexp_replace(fixed, "0{4}", "yyyy"), "(M+)-#", "$1-yy")
    df = df.withColumn("fixed", fixed)

    def width(letter: Column, run: Column) -> Column:
        return F.when(F.get("narrow", run), letter).otherwise(F.concat(letter, letter))

    # What stands for each # in turn: day, month and a year of two digits, and the time.
    date = []
    for run in range(3):
        letter = F.substring("order", run + 1, 1)
        year = F.when(~F.col("fixed").contains("yy"), F.lit("yy"))
        date.append(F.when(letter == "y", year).when(letter != "", width(letter, F.lit(run))))
    hour = F.when(F.col("shape").endswith("a"), "h").otherwise("H")
    time = [width(letter, F.length("order") + i) for i, letter in enumerate((hour, F.lit("m"), F.lit("s")))]
    df = df.withColumn("letters", F.array_compact(F.when(F.col("fixed").startswith("yyyyMMdd"), F.array(*time)).otherwise(F.array(*date, *time))))
    between = F.split("fixed", "#")
    filled = F.transform(between, lambda part, i: F.when(i == 0, part).otherwise(F.concat(F.get("letters", i - 1), part)))
    return df.withColumn("pattern", F.array_join(filled, ""))


def date_formats(df: DataFrame, column: str, prefer: str = "Mdy") -> DataFrame:
    """``shape, n, pattern, evidence, certain`` for the shapes of a text column; NULL: no date.

    ``n`` counts all values of the shape (NULL values are not counted). A shape has a row
    for each order of year, month and day that is proven, with the number of values that
    no other order reads as ``evidence``. If none is, it has one row with the order that reads
    most values, of equal ones that of ``prefer`` (``Mdy`` or ``dMy``); this is ``certain``
    only if the shape has no other order. Everything after one aggregate is a few rows.
    """
    if prefer not in ("Mdy", "dMy"):
        raise ValueError(f"unknown prefer {prefer!r}")
    values = df.select(F.col(f"`{column}`").cast("string").alias("text")).filter("text IS NOT NULL")
    values = values.withColumn("shape", shape(F.col("text")))
    runs = F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))
    first = F.get(runs, F.lit(0))
    # The day of a compact shape is one run, but counts as three.
    day = F.array(first.substr(1, 4), first.substr(5, 2), first.substr(7, 2))
    apart = F.when(_kind(F.col("shape")) == "compact", F.concat(day, F.slice(runs, 2, RUNS))).otherwise(runs)
    values = values.withColumns({"orders": _orders(_kind(F.col("shape")), prefer), "runs": F.when(F.col("shape").isNotNull(), apart)})
    readers = [
        F.when(F.array_contains("orders", o) & _reads(o, F.col("runs")), F.lit(o)) for o in sorted({o for all_ in ORDERS.values() for o in all_})
    ]
    values = values.withColumn("readers", F.array_compact(F.array(*readers)))
    narrow = [F.coalesce(F.min(F.length(F.get("runs", F.lit(i)))) == 1, F.lit(False)) for i in range(RUNS)]
    counted = values.groupBy("shape", "orders", "readers").agg(F.count(F.lit(1)).alias("n"), F.array(*narrow).alias("narrow"))

    tried = counted.select("*", F.posexplode_outer("orders").alias("place", "order"))
    only = F.col("readers") == F.array("order")
    by_order = tried.groupBy("shape", "order", "place").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(only, F.col("n"))), F.lit(0)).alias("evidence"),
        F.coalesce(F.sum(F.when(F.array_contains("readers", F.col("order")), F.col("n"))), F.lit(0)).alias("fits"),
        F.array(*[F.max(F.col("narrow")[i]) for i in range(RUNS)]).alias("narrow"),
        F.max(F.size("orders")).alias("orders"),
    )
    same = Window.partitionBy("shape")
    best = by_order.withColumns(
        {"proven": F.max("evidence").over(same), "place": F.row_number().over(same.orderBy(F.desc("fits"), "place"))}
    )
    chosen = best.filter((F.col("evidence") > 0) | ((F.col("proven") == 0) & (F.col("place") == 1)))
    certain = (F.col("evidence") > 0) | (F.col("orders") == 1)
    return _with_pattern(chosen).select("shape", "n", "pattern", "evidence", F.coalesce(certain, F.lit(False)).alias("certain"))


def likely_formats(df: DataFrame, column: str, prefer: str = "Mdy", most: int = 8) -> tuple[str, ...]:
    """Formats to parse a column with, those of the most usual shapes first; at most ``most``."""
    found = date_formats(df, column, prefer).filter("pattern IS NOT NULL")
    rows = found.groupBy("pattern").agg(F.sum("n").alias("n"), F.max("evidence").alias("evidence"))
    return tuple(r[0] for r in rows.orderBy(F.desc("n"), F.desc("evidence"), "pattern").limit(most).collect())
