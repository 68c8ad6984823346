"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: numbers, units and names turn into typed placeholders, everything
else is lower-cased. Windows of ``window`` template tokens of the documents are hash-joined with
those of the benchmark; where windows meet, the slots must agree: each name, number or unit of the
item must always stand for the same value in the document, and two names for two. So a question
with other numbers or names is caught, and a chance meeting of templates is not.

A text has two readings. In the first only numbers and units are placeholders, so it doesn't depend
on letter case: an item in other letters, or after other words, has the same template. In the second
a run of capitalised words is one name. Which of an item's names may change is settled on the
benchmark's side: a capitalised word that the benchmark also writes small (a sentence opener such as
"What") must stand for itself.

A window of the first reading that is nearly all placeholders, and an item of fewer than
``min_tokens`` words, say nothing as templates; their words are hashed as they are, so such an item
is found where it stands word for word. No item and no window is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import anti_by_key, cut, fits, let, salted_join, text_key

WINDOW = 8
# Unit words that follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound pounds ton tons tonne tonnes ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur percent degree degrees kmh mph watt watts volt volts joule joules newton newtons"
).split()
# Words that open questions and sentences without being names.
OPENERS = "a an and are as at by can could did do does find for from give has have how if in is it its let no not of on or she he they we you i the then there these this those to was were what when where which while who whom whose why will with".split()
#: Placeholders; words begin with none of these characters, and all are smaller than letters.
NUMBER, UNIT, NAME = "#", "%", "@"
#: Words are runs of letters, or numbers with marks inside.
WORD = r"\p{N}++(?:[.,]\p{N}++)*+|[\p{L}\p{M}]++"
#: Readings of a window: its template without names, with names, and its words as they are.
PLAIN, NAMED, VERBATIM = 0, 1, 2


def words(text: Column) -> Column:
    """Words as they are written; none for texts without letters and digits."""
    return F.regexp_extract_all(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("ß"), F.lit("ss")), F.lit(WORD), 0)


def lowered(ws: Column) -> Column:
    return F.transform(ws, lambda x: F.lower(x))


def template(low: Column) -> Column:
    """Lower-cased words with placeholders for numbers (which begin with 0-9) and the units behind them."""
    numbers = F.transform(low, lambda x: F.when(x < ":", F.lit(NUMBER)).otherwise(x))
    return let(numbers, lambda t: F.transform(t, lambda x, i: F.when((F.get(t, i - 1) == NUMBER) & x.isin(UNITS), F.lit(UNIT)).otherwise(x)))


def named(ws: Column, plain: Column) -> Column:
    """The template with a placeholder for each word that has a capital letter."""
    return F.zip_with(plain, ws, lambda t, w: F.when((t > UNIT) & (t != w), F.lit(NAME)).otherwise(t))


def one_name(t: Column) -> Column:
    """Runs of names as one."""
    return F.filter(t, lambda x, i: (x != NAME) | (i == 0) | (F.get(t, i - 1) != NAME))


def window_hashes(tokens: Column, window: int = WINDOW) -> Column:
    """Hashes of all windows, built by doubling; shorter texts give none."""
    hashes, width = F.transform(tokens, lambda x: F.xxhash64(x)), 1
    while width < window:
        step = min(width, window - width)
        hashes = let(hashes, _joiner(step))
        width += step
    return hashes


def _joiner(step: int):
    """Joins each hash with the one ``step`` places on, as far as there is one."""
    return lambda hashes: F.zip_with(F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - step, F.lit(0))), F.slice(hashes, F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b))


def _starts(t: Column) -> Column:
    """Places at which ``one_name`` keeps a token."""
    return F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i) != NAME) | (F.get(t, i - 1) != NAME))


def _value(kind: Column, ws: Column) -> Column:
    """Hash of a slot's kind and words; its last bit tells names (0) from numbers and units (1)."""
    return F.shiftleft(F.xxhash64(kind, ws), 1) + F.when(kind == NAME, 0).otherwise(1)


def _values(t: Column, low: Column) -> Column:
    """For every token of ``one_name(t)`` the hash of the words it stands for, or null if it is no placeholder."""
    ends = let(_starts(t), lambda s: F.transform(s, lambda at, i: F.struct(at.alias("at"), F.coalesce(F.get(s, i + 1), F.size(t)).alias("to"))))
    value = lambda e: _value(F.get(t, e["at"]), F.slice(low, e["at"] + 1, e["to"] - e["at"]))
    each = F.transform(ends, lambda e: F.when(F.get(t, e["at"]).isin(NUMBER, UNIT, NAME), value(e)))
    return F.when(F.size(t) > 0, each).otherwise(F.array().cast("array<bigint>"))


def _readings(rows: DataFrame) -> DataFrame:
    """Add the readings of ``_text``: _w (lower-cased words), _p and _n (templates), _ps and _ns (values of their slots)."""
    rows = rows.withColumn("_raw", words(F.col("_text"))).withColumn("_w", lowered(F.col("_raw"))).withColumn("_p", template(F.col("_w")))
    rows = rows.withColumn("_full", named(F.col("_raw"), F.col("_p")))
    return rows.withColumns({"_n": one_name(F.col("_full")), "_ps": _values(F.col("_p"), F.col("_w")), "_ns": _values(F.col("_full"), F.col("_w"))})


def _windows(tokens: Column, values: Column, window: int) -> Column:
    """pos, h, slots (values of the placeholders, in order) of each window."""
    return F.transform(window_hashes(tokens, window), lambda h, i: F.struct(i.alias("pos"), h.alias("h"), F.array_compact(F.slice(values, i + 1, F.lit(window))).alias("slots")))


def _verbatim(low: Column, window: int) -> Column:
    return F.transform(window_hashes(low, window), lambda h, i: F.struct(i.alias("pos"), h.alias("h"), F.array().cast("array<bigint>").alias("slots")))


def _of_kind(windows: Column, kind: int) -> Column:
    return F.transform(windows, lambda w: F.struct(F.lit(kind).alias("kind"), w["pos"].alias("_pos"), w["h"].alias("h"), w["slots"].alias("_slots")))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, min_tokens: int = 4) -> DataFrame:
    """item, reading, kind, width, pos, h, slots, fixed, n_windows: every window of every distinct item text.

    ``item`` is the key of the item's text, so equal items are one. Items shorter than ``window`` are one
    window. ``kind`` is VERBATIM where the words themselves are hashed; such windows belong to the first reading
    and have its positions. ``fixed`` holds the slots whose value may not change.
    """
    texts = benchmark.where("item_id IS NOT NULL").select(F.col("text").cast("string").alias("_text")).distinct()
    items = _readings(texts).where(F.size("_w") > 0).withColumn("item", text_key(F.col("_text")))
    items = cut(items.select("item", "_raw", "_w", "_p", "_full", "_n", "_ps", "_ns", F.size("_w").alias("_size")))
    small = items.select(F.explode(F.filter(F.zip_with("_raw", "_w", lambda r, x: F.when(r == x, x)), lambda x: x.isNotNull())).alias("x")).distinct()
    # A name slot may not change if every word of it is also written small, or opens sentences.
    runs = items.select("item", "_full", "_w", F.explode(_starts(F.col("_full"))).alias("_at")).where(F.get("_full", F.col("_at")) == NAME)
    length = F.array_position(F.transform(F.slice("_full", F.col("_at") + 1, F.size("_full")), lambda x: x == NAME), False)
    runs = runs.withColumn("_run", F.slice("_w", F.col("_at") + 1, F.when(length > 0, length - 1).otherwise(F.size("_w") - F.col("_at")).cast("int")))
    each = runs.select("item", _value(F.lit(NAME), F.col("_run")).alias("value"), F.explode("_run").alias("x"))
    common = small.unionByName(benchmark.sparkSession.createDataFrame([(x,) for x in OPENERS], "x string")).distinct().withColumn("_small", F.lit(True))
    fixed = each.join(common, "x", "left").groupBy("item", "value").agg(F.bool_and(F.coalesce("_small", F.lit(False))).alias("_all")).where("_all")
    fixed = fixed.groupBy("item").agg(F.collect_set("value").alias("_fixed"))
    items = cut(items.join(fixed, "item", "left").withColumn("_fixed", F.coalesce("_fixed", F.array().cast("array<bigint>"))))
    widths = items.select(F.explode(F.array(F.least(F.size("_p"), F.lit(window)), F.least(F.size("_n"), F.lit(window)))).alias("width")).distinct().collect()  # at most ``window`` rows
    found = None
    for width in sorted(r["width"] for r in widths):
        own = items.where(F.least(F.size("_p"), F.lit(window)) == width)
        tokens = F.slice("_p", F.col("pos") + 1, F.lit(width))
        rows = own.select("item", "_size", "_p", "_fixed", F.explode(F.zip_with(_windows(F.col("_p"), F.col("_ps"), width), _verbatim(F.col("_w"), width), lambda a, v: F.struct(a.alias("a"), v["h"].alias("v")))).alias("e"))
        rows = rows.select("item", "_size", "_fixed", "_p", F.col("e.a.pos").alias("pos"), F.col("e.a.h").alias("_h"), F.col("e.a.slots").alias("_slots"), "e.v")
        says = (F.col("_size") >= min_tokens) & (8 * F.size(F.filter(tokens, lambda x: x > NAME)) >= 3 * width)
        as_is = [F.when(says, F.col("_slots")).otherwise(F.array().cast("array<bigint>")).alias("slots"), F.when(says, F.lit(PLAIN)).otherwise(F.lit(VERBATIM)).alias("kind"), F.when(says, F.col("_h")).otherwise(F.col("v")).alias("h")]
        rows = rows.select("item", F.lit(PLAIN).alias("reading"), F.lit(width).alias("width"), "pos", *as_is, F.array().cast("array<bigint>").alias("fixed"))
        own = items.where((F.least(F.size("_n"), F.lit(window)) == width) & F.array_contains("_n", NAME) & (F.size("_n") >= min_tokens))
        more = own.select("item", "_n", "_fixed", F.explode(_windows(F.col("_n"), F.col("_ns"), width)).alias("e")).select("item", "_n", "_fixed", "e.*")
        more = more.where(8 * F.size(F.filter(F.slice("_n", F.col("pos") + 1, F.lit(width)), lambda x: x > NAME)) >= 3 * width)
        more = more.select("item", F.lit(NAMED).alias("reading"), F.lit(width).alias("width"), "pos", "slots", F.lit(NAMED).alias("kind"), "h", F.array_intersect("slots", "_fixed").alias("fixed"))
        rows = rows.unionByName(more)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return benchmark.sparkSession.createDataFrame([], "item struct<a: bigint, b: bigint>, reading int, width int, pos int, slots array<bigint>, kind int, h bigint, fixed array<bigint>, n_windows bigint")
    counts = found.groupBy("item", "reading").agg(F.count("*").alias("n_windows"))
    return found.join(counts, ["item", "reading"])


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: float = 0.5, max_windows: int = 1_000_000) -> DataFrame:
    """_k (key of a text), item_id, n_matched, share: the texts that hold an item.

    A text holds an item if at least ``min_share`` of the windows of one reading of the item meet it
    at one offset, or at offsets less than ``window`` apart, with consistent slots. All windows of all texts are hashed
    and joined. A side is broadcast while it has no more than ``max_windows`` rows (of at most 300
    bytes each), and joined by shuffle, windows that many items share being salted, otherwise.
    """
    bench = cut(benchmark_windows(benchmark, window))
    kinds = {(r["kind"], r["width"]) for r in bench.select("kind", "width").distinct().collect()}  # at most 3 * window rows
    keys = cut(bench.select("h").distinct())
    texts = docs.select(F.col("text").cast("string").alias("_text"))
    if not kinds:
        return texts.select(text_key(F.col("_text")).alias("_k"), F.lit(None).cast("long").alias("item_id"), F.lit(0).cast("long").alias("n_matched"), F.lit(0.0).alias("share")).limit(0)

    # First the texts that meet any window; only hashes are made.
    def hashes(ws: Column) -> Column:
        return let(lowered(ws), lambda low: let(template(low), lambda t: _hashes(ws, low, t)))

    def _hashes(ws: Column, low: Column, t: Column) -> Column:
        of = {PLAIN: lambda: t, NAMED: lambda: one_name_of(named(ws, t)), VERBATIM: lambda: low}
        all_ = [window_hashes(of[kind](), width) for kind, width in sorted(kinds)]
        return F.concat(*all_) if len(all_) > 1 else all_[0]

    one_name_of = lambda t: let(t, one_name)
    probe = texts.select(text_key(F.col("_text")).alias("_k"), F.explode(let(words(F.col("_text")), hashes)).alias("h"))
    met = cut(probe.join(F.broadcast(keys) if fits(keys, max_windows) else keys, "h", "left_semi").select("_k").distinct())

    # Then their windows with slots. Copies of a text are read each, and fall together in the groups.
    own = texts.withColumn("_k", text_key(F.col("_text")))
    held = _readings(own.join(F.broadcast(met) if fits(met, max_windows) else met, "_k", "left_semi"))
    windows = {
        PLAIN: lambda width: _windows(F.col("_p"), F.col("_ps"), width),
        NAMED: lambda width: _windows(F.col("_n"), F.col("_ns"), width),
        VERBATIM: lambda width: _verbatim(F.col("_w"), width),
    }
    lists = [_of_kind(windows[kind](width), kind) for kind, width in sorted(kinds)]
    each = held.select("_k", F.explode(F.concat(*lists) if len(lists) > 1 else lists[0]).alias("e")).select("_k", "e.*")
    if fits(bench, max_windows // 4):
        joined = each.join(F.broadcast(bench), ["h", "kind"])
    else:
        joined = salted_join(each.join(F.broadcast(keys) if fits(keys, max_windows) else keys, "h", "left_semi"), bench, ["h", "kind"], F.xxhash64("_k"))
    pairs = F.transform(F.arrays_zip(F.col("slots").alias("item"), F.col("_slots").alias("doc")), lambda s: F.struct(s["item"].alias("item"), s["doc"].alias("doc"), F.array_contains("fixed", s["item"]).alias("fixed")))
    offset = F.col("_pos") - F.col("pos")
    # At one offset, and at offsets near each other: every two less than ``window`` apart share one of the last two.
    near = F.array(F.struct(F.lit(0), offset), F.struct(F.lit(1), F.floor(offset / (2 * window)).cast("int")), F.struct(F.lit(2), F.floor((offset + window) / (2 * window)).cast("int")))
    rows = joined.select("_k", "item", "reading", "n_windows", "pos", pairs.alias("pairs"), F.explode(near).alias("at"))
    groups = rows.groupBy("_k", "item", "reading", "n_windows", "at").agg(F.size(F.collect_set("pos")).cast("long").alias("n_matched"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    enough = groups.withColumn("share", F.col("n_matched") / F.col("n_windows")).where(F.col("share") >= min_share)
    # A slot has one value, and two names stay two; numbers and units of different slots may come out equal.
    same = lambda pairs, f: F.size(F.array_distinct(F.transform(pairs, lambda s: s[f]))) == F.size(pairs)
    of_names = F.filter("pairs", lambda s: s["item"] % 2 == 0)
    good = enough.where(same(F.col("pairs"), "item") & same(of_names, "doc") & ~F.exists("pairs", lambda s: s["fixed"] & (s["item"] != s["doc"])))
    best = good.groupBy("_k", "item").agg(F.max(F.struct("share", "n_matched")).alias("m"))
    names = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), text_key(F.col("text").cast("string")).alias("item")).distinct()
    return best.join(names, "item").select("_k", "item_id", "m.n_matched", "m.share")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, n_matched, share: one row for each document row that holds an item.

    Null and empty texts hold nothing; null item ids and items without a word are skipped; items of one text are
    found together; repeated rows give repeated results; columns other than doc_id, text, item_id are ignored. Empty
    tables give no rows. An item of a single word is found wherever that word stands.
    """
    found = cut(find(docs, benchmark, **options))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text").cast("string")).alias("_k"))
    return rows.join(F.broadcast(found) if fits(found, 500_000) else found, "_k").select("doc_id", "item_id", "n_matched", "share")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns are kept, whatever their names."""
    found = cut(find(docs, benchmark, **options).select("_k").distinct())
    return anti_by_key(docs, text_key(F.col("text").cast("string")), found)
