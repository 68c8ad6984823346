import random
import re

from pyspark.sql import functions as F

from taxaspark.llm import decontaminate as D

ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km to reach Lyon before the evening comes. How fast does the train go?"),
    (2, "What is the capital city of the large country in the north"),
    (3, "one two three four five"),
    (4, None), (5, "too short"), (None, "An item without an id is never matched by any text at all here"),
    (6, "12 13 14 15 16 17 18 19 20 21 22 23"),
]


def flagged(spark, docs, texts):
    bench = spark.createDataFrame([(*x, "h") for x in ITEMS], "item_id long, text string, h string")
    return sorted((r["doc_id"], r["item_id"]) for r in D.contaminated(docs(list(enumerate(texts))), bench).collect())


def test_canonical_tokens(spark):
    c = spark.createDataFrame([("He saw Anna Bell 3,000 km away, at 2.5 pm. Then she, 7b, aß",)], "t string").select(D.words(F.col("t")).alias("r"))
    c = c.withColumn("w", D.lowered(F.col("r"))).withColumn("t", D.template(F.col("w"))).withColumn("f", D.named(F.col("r"), F.col("t")))
    r = c.withColumns({"n": D.one_name(F.col("f")), "v": D._values(F.col("f"), F.col("w"))}).first()
    assert r["w"] == ["he", "saw", "anna", "bell", "3,000", "km", "away", "at", "2.5", "pm", "then", "she", "7", "b", "ass"]
    assert r["t"] == ["he", "saw", "anna", "bell", "#", "%", "away", "at", "#", "pm", "then", "she", "#", "b", "ass"]
    assert r["n"] == ["@", "saw", "@", "#", "%", "away", "at", "#", "pm", "@", "she", "#", "b", "ass"]
    assert [v is not None for v in r["v"]] == [x in "@#%" for x in r["n"]]


def test_planted_and_clean(spark, docs):
    rng = random.Random(1)
    noise = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta the of a to".split()) for _ in range(n))
    other = ITEMS[0][1].replace("Paris", "Rome").replace("Lyon", "Milan").replace("120 km", "75 miles").replace("9", "11")
    clash = "Rome Rome".join(ITEMS[0][1].split("Paris"))
    texts = [
        noise(50) + " " + ITEMS[0][1] + " " + noise(40),
        noise(30) + ".\n" + other + " " + noise(10),  # the same question with other slots
        noise(200),
        ITEMS[1][1].upper() + "!!",
        "so " + ITEMS[2][1] + " six",
        None, "", "too short", ITEMS[6][1],
        " ".join(f"{w}%%%" for w in ITEMS[1][1].split()),
        noise(20_000) + " " + ITEMS[1][1],
        ITEMS[5][1],
    ]
    del clash
    assert flagged(spark, docs, texts) == [(0, 1), (1, 1), (3, 2), (4, 3), (7, 5), (8, 6), (9, 2), (10, 2)]


def test_inconsistent_slots_are_no_match(spark, docs):
    item = "when Tom meets Ann then Tom gives Ann one apple and Ann gives Tom one pear"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    good = item.replace("Tom", "Max").replace("Ann", "Eve")
    bad = "when Max meets Eve then Leo gives Ida one apple and Max gives Kim one pear"
    out = D.contaminated(docs([(1, good), (2, bad)]), bench)
    assert [r["doc_id"] for r in out.collect()] == [1]


def test_window_hashes_and_drop(spark, docs):
    df = spark.createDataFrame([(["a", "b", "c", "d", "a", "b", "c"],)], "t array<string>")
    for w in (1, 2, 3, 5, 8):
        h = df.select(D.window_hashes(F.col("t"), w).alias("h")).first()["h"]
        assert len(h) == max(0, 8 - w)
        if w == 3:
            assert h[0] == h[4] and len(set(h)) == 4
    bench = spark.createDataFrame([(1, ITEMS[1][1])], "item_id long, text string")
    d = docs([(1, "x " + ITEMS[1][1]), (2, "clean"), (None, ITEMS[1][1]), (3, None)])
    kept = D.drop_contaminated(d, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and kept.columns == d.columns
    assert D.drop_contaminated(d, bench.limit(0)).count() == 4
    assert D.contaminated(docs([]), bench).count() == 0
    # more windows than may be broadcast: the shuffled join finds the same
    assert [r["doc_id"] for r in D.contaminated(d, bench, max_windows=0).where("doc_id IS NOT NULL").collect()] == [1]


def test_every_item_in_any_letters(spark, docs, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = [(r["item_id"], r["text"]) for r in bench.collect()] + [(900, "What is osmosis?"), (901, "Was Napoleon born in Corsica or in France"), (902, "12 + 30 = 42"), (903, "Straße")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    forms = [str.lower, str.upper, str.title, lambda t: "so " + t, lambda t: "Question: " + t + " And so on", lambda t: t]
    texts = [(100 * i + k, f(t)) for i, t in rows for k, f in enumerate(forms)]
    found = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs(texts), bench).collect()}
    assert {(100 * i + k, i) for i, _ in rows for k in range(len(forms))} <= found


def test_other_names_and_numbers(spark, docs):
    item = "Tom has 12 apples. Ann gives Tom 3 more. How many apples does he have?"
    other = ["Mary Jane has 7 apples. Peter Paul Smith gives Mary Jane 30 more. How many apples does he have?", "tom has 9 apples. ann gives tom 2 more. how many apples does he have?"]
    bench = spark.createDataFrame([(1, item), (2, "What is the capital of France")], "item_id long, text string")
    got = D.contaminated(docs([*enumerate(other), (5, "Rome is the capital of Italy."), (6, "What is the capital of Old Spain?"), (7, "Tom has 12 apples. Leo gives Ida 3 more. How many pears does he have")]), bench)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(0, 1), (1, 1), (6, 2)]


def plain(items, docs, window=8):
    """The same search, text by text, over pairs of every document and every item."""
    words = lambda t: re.findall(r"\d+(?:[.,]\d+)*|[^\W\d_]+", t.replace("ß", "ss"))
    small = set(D.OPENERS) | {w for _, t in items for w in words(t) if w == w.lower()}

    def readings(text):
        raw = words(text)
        low, first = [w.lower() for w in raw], []
        for w in raw:
            first.append("%" if first and first[-1] == "#" and w.lower() in D.UNITS else "#" if w[0].isdigit() else w.lower())
        second, k = [], 0
        while k < len(raw):
            j = k + 1
            if first[k] not in "#%" and raw[k] != low[k]:
                while j < len(raw) and first[j] not in "#%" and raw[j] != low[j]:
                    j += 1
                second.append(("@", tuple(low[k:j])))
            else:
                second.append((first[k], (low[k],)))
            k = j
        return [(t, (w,)) for t, w in zip(first, low)], second

    found = set()
    for i, text in items:
        for r, own in enumerate(readings(text)):
            width = min(window, len(own))
            says = lambda part: len(own) >= 4 and 8 * sum(t not in "#%@" for t, _ in part) >= 3 * width  # noqa: E731, B023
            spots = [own[k : k + width] for k in range(len(own) - width + 1)]
            if r:
                if not any(t == "@" for t, _ in own):
                    continue
                spots = [(k, s) for k, s in enumerate(spots) if says(s)]
            else:
                spots = [(k, s if says(s) else [(v[0], v) for _, v in s]) for k, s in enumerate(spots)]
            for d, doc in docs:
                there = readings(doc)[r]
                hits = {}
                for at in range(len(there) - width + 1):
                    part = there[at : at + width]
                    for k, s in spots:
                        if [t for t, _ in s] == [t for t, _ in part] or (not r and [v for _, v in s] == [v for _, v in part] and not says(s)):
                            pairs = [] if not r and s[0][0] == s[0][1][0] and all(t == v[0] for t, v in s) else [(x, y) for x, y in zip(s, part) if x[0] in "#%@"]
                            for key in ((0, at - k), (1, (at - k) // (2 * window)), (2, (at - k + window) // (2 * window))):
                                hits.setdefault(key, []).append((k, pairs))
                for got in hits.values():
                    pairs = {p for _, ps in got for p in ps}
                    one = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
                    fixed = all(a == b for a, b in pairs if a[0] == "@" and set(a[1]) <= small)
                    if one and fixed and len({k for k, _ in got}) >= 0.5 * len(spots):
                        found.add((d, i))
    return found


def test_equals_a_plain_search(spark, docs, sf_dir):
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) < 2500").orderBy("doc_id").limit(30).collect()
    rows = [(r["doc_id"], r["text"]) for r in own if r["text"]]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()] + [(800, "Ann saw 3 cats"), (801, "of the 12 in 7 for 8 at 9 on"), (802, "to be")]
    rows += [(5000, "Now Bob saw 4 cats and Ann saw 5 dogs to be of The 12 in 7 for 8 at 9 on"), (5001, "of the 13 in 7 for 8 at 9 on"), (5002, items[0][1].upper() + " " + items[1][1])]
    got = D.contaminated(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == plain(items, rows)


def test_slots_of_numbers_may_come_out_equal(spark, docs):
    item = "Tom has 3 apples and Ann has 5 apples. How many apples do Tom and Ann have in all together?"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    other = lambda a, b, x, y: f"Sum it up: {a} has {x} apples and {b} has {y} apples. How many apples do {a} and {b} have in all together? Fine."
    texts = [other("Tom", "Ann", 4, 4), other("Max", "Eve", 7, 7), other("Max", "Eve", 3, 9), other("Max", "Max", 3, 9), "Tom has 3 apples and Ann has 5 pears today."]
    got = {r["doc_id"] for r in D.contaminated(docs(list(enumerate(texts))), bench).collect()}
    assert {0, 1, 2} <= got and not got & {3, 4}
