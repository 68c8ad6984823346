import ipaddress
import re

from pyspark.sql import functions as F

from taxaspark.llm import pii as P

ROWS = [
    (1, "Write to Ann.Lee7@Mail3.example.com or ann.lee7@mail3.example.com, not to BOB@X.ORG."),
    (2, "Call +1 (017) 555-7713 or +1 017-555-7713; at home (212) 555-0100."),
    (3, "Host 97.51.17.173 and 256.1.1.1, version 1.2.3, card 9807915762804490 or 9807 9157 6280 4490!"),
    (4, 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" SSN 078-05-1120, IBAN DE44 5001 0517 5407 3249 31.'),
    (5, "Mr. John Smith met Mrs Smith and Frau Müller; г-жа Иванова came. Mr John Smith left."),
    (6, None), (7, ""), (8, "No data: 12 apples, 3.5 km, page 1234567."), (8, "No data: 12 apples, 3.5 km, page 1234567."),
    (9, "x@y.zz " * 5000),
]


def run(docs, rows):
    return {r["doc_id"]: r for r in P.replace(docs(rows)).collect()}


def test_kinds_formats_and_coreference(docs):
    out = run(docs, ROWS)
    kinds = {i: [e["kind"] for e in r["entities"]] for i, r in out.items()}
    assert kinds[1] == ["email"] * 3 and kinds[2] == ["phone"] * 3 and kinds[3] == ["ip", "card", "card"] and kinds[4] == ["token", "national", "iban"]
    assert kinds[5] == ["male-latin", "female-latin", "female-latin", "female-cyrillic", "male-latin"]
    said = {i: [e["surrogate"] for e in r["entities"]] for i, r in out.items()}
    assert said[1][0] == said[1][1] and said[1][2] == said[1][2].upper()
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", said[2][0]) and re.sub(r"\D", "", said[2][0]) == re.sub(r"\D", "", said[2][1])
    ipaddress.ip_address(said[3][0])
    assert said[3][1] == said[3][2].replace(" ", "") != "9807915762804490"
    assert re.fullmatch("[0-9a-f]{40}", said[4][0]) and re.fullmatch(r"\d{3}-\d{2}-\d{4}", said[4][1]) and said[4][2].startswith("DE")
    assert said[5][0].startswith("Mr. ") and said[5][0][4:] == said[5][4][3:] and re.fullmatch(r"г-жа [А-Я][а-я]+(?:ов|ев|ин)а", said[5][3])
    assert said[5][0].split()[2] == said[5][1].split()[1]  # one family
    for i, t in ROWS[:5]:
        for m in re.findall(r"\S+@\S+\w|\d{16}|b44e\w+|John|Müller|97\.51", t):
            assert m not in out[i]["text"]
    assert out[6]["text"] is None and out[7]["text"] == "" and out[8]["text"] == ROWS[7][1] and out[8]["n_entities"] == 0
    assert out[9]["n_entities"] == 5000 and len(set(out[9]["text"].split())) == 1
    assert "256.1.1.1" in out[3]["text"] and "1.2.3" in out[3]["text"]


def test_collisions_are_resolved(spark, docs):
    rows = [(i, f"Mr {chr(65 + i // 26 % 26)}{chr(97 + i % 26)}x and Frau {chr(65 + i % 26)}{chr(97 + i // 26)}y") for i in range(120)]
    out = run(docs, rows)
    assert any(re.findall(r"[a-zö]-[A-Z]", r["text"]) for r in out.values())  # some had to draw again
    assert not any("- " in r["text"] for r in out.values())
    seen = {}
    for i, t in rows:
        for name, e in zip(re.findall(r"(?:Mr|Frau) (\w+)", t), out[i]["entities"], strict=True):
            assert seen.setdefault(name, e["surrogate"].split()[-1]) == e["surrogate"].split()[-1]
    assert len(set(seen.values())) == len(seen)
    entities = spark.createDataFrame([("ip", f"10.0.{i}.{j}") for i in range(40) for j in range(40)], "kind string, name string")
    over = {r["name"]: r["attempt"] for r in P.collisions(entities).collect()}
    final = entities.select("name", P.surrogate(F.lit("ip"), F.col("name"), F.lit(0)).alias("s")).where(~F.col("name").isin(list(over))).collect()
    assert len({r["s"] for r in final}) == len(final) and not {r["s"] for r in final} & {f"10.0.{i}.{j}" for i in range(40) for j in range(40)}


def test_names_are_followed_through_the_text(docs):
    t = "Mr Jean Paul Martin met Dr von Berg. Martin said: Jean Paul Martin knows Berg, not Bergmann, nor Jean. Mrs Martin smiled."
    r = run(docs, [(1, t)])[1]
    m = re.fullmatch(r"Mr (\w+) (\w+) (\w+) met Dr von (\w+)\. (\w+) said: (\w+) (\w+) (\w+) knows (\w+), not Bergmann, nor Jean\. Mrs (\w+) smiled\.", r["text"])
    assert m and m[3] == m[5] == m[8] == m[10] and m[4] == m[9] and (m[1], m[2]) == (m[6], m[7])
    assert not {"Paul Martin", "Berg"} & {f"{m[2]} {m[3]}", m[4]} and r["n_entities"] == 8
    r = run(docs, [(2, "Господин Иванов и Госпожа Иванова; Иванова ушла.")])[2]["text"]
    m = re.fullmatch(r"Господин (\w+) и Госпожа (\w+); (\w+) ушла\.", r)
    assert m and m[2] == m[3] == m[1] + "а" and m[1] != "Иванов"


def test_common_words_stay(docs):
    t = "Mrs May met Mr Young. In May 2020, Young people cheered. May I ask? Mr Marten saw a marten. Marten ran. Dr Lindt came in 1999; Lindt 1845 is a brand, Lindt left."
    r = run(docs, [(1, t)])[1]
    m = re.fullmatch(r"Mrs (\w+) met Mr (\w+)\. In May 2020, Young people cheered\. May I ask\? Mr (\w+) saw a marten\. Marten ran\. Dr (\w+) came in 1999; Lindt 1845 is a brand, (\w+) left\.", r["text"])
    assert m and m[4] == m[5] and not {"May", "Young", "Marten", "Lindt"} & set(m.groups())
    only = run(docs, [(1, "Mr May came. May is a month.")])[1]["text"]  # all told names are common words
    assert re.fullmatch(r"Mr (?!May)\w+ came\. May is a month\.", only)


def test_names_of_any_shape(docs):
    rows = [
        (1, "Dr. John Ronald Reuel Tolkien wrote. Tolkien left."),
        (2, "Mr. O'Brien and Mr McDonald; McDonald's car, O’Brien."),
        (3, "Mr Smith's house, Mr Smith came. Mrs D’Angelo'll sing."),
        (4, "Mr. J. R. Ewing saw Prof K Müller-Lüdenscheidt and Dr W. de la Vega."),
        (5, "Mr " + " ".join(["Anna"] * 5000) + " and Mr A" + "a" * 200_000),
    ]
    out = {i: r["text"] for i, r in run(docs, rows).items()}
    # A surrogate that had to be drawn again has a hyphen.
    m = re.fullmatch(r"Dr\. ([\w-]+) ([\w-]+) ([\w-]+) ([\w-]+) wrote\. ([\w-]+) left\.", out[1])
    assert m and m[4] == m[5] and not {"John", "Ronald", "Reuel", "Tolkien"} & set(m.groups())
    m = re.fullmatch(r"Mr\. ([\w-]+) and Mr ([\w-]+); ([\w-]+)'s car, ([\w-][\w’-]*)\.", out[2])
    assert m and m[2] == m[3] and not re.search("Brien|Donald", " ".join(m.groups()[:3]))
    m = re.fullmatch(r"Mr ([\w-]+)'s house, Mr ([\w-]+) came\. Mrs ([\w-]+)'ll sing\.", out[3])
    assert m and m[1] == m[2] != "Smith" and "Angelo" not in m[3]
    assert re.fullmatch(r"Mr\. J\. R\. [\w-]+ saw Prof K [\w-]+ and Dr W\. de la [\w-]+\.", out[4]) and not re.search("Ewing|Müller|Vega", out[4])
    assert out[5] is not None and "aaaa" not in out[5].split(" and ")[1]


def test_formats_that_run_out_grow(spark, docs):
    local = list("abcdefghijklmnopqrstuvwxyzéèàç")
    out = run(docs, [(i, f"{c}@example.com") for i, c in enumerate(local)])
    assert len({r["text"] for r in out.values()}) == len(local) and not any(r["text"].startswith("@") for r in out.values())
    draws = spark.range(12).select(P.surrogate(F.lit("ip"), F.lit("1.2.3.4"), F.col("id").cast("int")).alias("s"), "id").collect()
    assert all(ipaddress.ip_address(r["s"]) in ipaddress.ip_network("10.0.0.0/8") for r in draws if r["id"] < 3)
    assert all(int(r["s"].split(".")[0]) >= 240 for r in draws if 3 <= r["id"] < 8)
    assert run(docs, [(1, "id " + "0a" * 500)])[1]["entities"][0]["kind"] == "token"


def test_scripts_codes_and_check_digits(docs):
    rows = [(1, "иван.петров@почта.example.com"), (2, "+49 30 123456 78 +380 44 123 45 67 030 1234567 on 01-2003"), (3, "4111 1111 1111 1111 and 4111111111111112"), (4, "GB82 WEST 1234 5698 7654 32 DE89370400440532013000"), (5, "at 2001:db8::8a2e:370:7334 or fe80:0:0:0:1:2:3:4, not std::vector")]
    out = run(docs, rows)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10
    said = {i: [e["surrogate"] for e in r["entities"]] for i, r in out.items()}
    kinds = {i: [e["kind"] for e in r["entities"]] for i, r in out.items()}
    assert kinds[1] == [] or re.fullmatch(r"[а-я]+\.[а-я]+@.*", said[1][0])
    assert kinds[2] == ["phone"] * 3 and said[2][0].startswith("+49 ") and said[2][1].startswith("+380 ") and re.fullmatch(r"0\d\d \d{7}", said[2][2]) and out[2]["text"].endswith("on 01-2003")
    assert said[3][0] != rows[2][1][:19] and said[3][0][0] == "4" and luhn(said[3][0].replace(" ", "")) == 0
    for x in said[4]:
        x = x.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 and x[:2] in ("GB", "DE")
    assert kinds[5] == ["ip6", "ip6"] and [ipaddress.ip_address(x).version for x in said[5]] == [6, 6]
    assert re.fullmatch(r"[а-я]+\.[а-я]+@mx\w+\.example\.org", run(docs, [(1, "иван.петров@example.com")])[1]["text"])


def plain_surrogate(kind, name, attempt=0, key=P.KEY):
    """The draw computed without Spark."""
    import hashlib

    seed = "\u0001".join([key, kind, str(attempt), name])
    s = hashlib.sha256(seed.encode()).hexdigest() + hashlib.sha256(("2" + seed).encode()).hexdigest()
    number = lambda i, base: int(s[i * 5 % 121 :][:4], 16) % base
    digits = lambda t: "".join(str(number(i, 10)) if c.isdigit() else c for i, c in enumerate(t))
    if kind == "ip":
        return "10." + ".".join(str(number(i, 256)) for i in (1, 2, 3))
    if kind == "national":
        return digits(name)
    if kind.startswith("last-"):
        stems, endings = P.LAST[kind[5:]]
        names = [a + b for a in stems for b in endings]
        return "-".join(names[number(i + 3, len(names))] for i in range(attempt + 1)).lower()
    if kind == "email":
        local, domain = name.split("@")
        letter = lambda c, i: P.LETTERS["Cyrillic" if "а" <= c <= "я" else "Latin"]
        local = "".join(str(number(i, 10)) if c.isdigit() else letter(c, i)[number(i, len(letter(c, i)))] if c.isalpha() else c for i, c in enumerate(local))
        return local + "@mx" + hashlib.sha256((key + "@" + domain).encode()).hexdigest()[:6] + ".example.org"
    raise ValueError(kind)


def test_draws_equal_plain_code(spark):
    rows = [("ip", "1.2.3.4"), ("national", "078051120"), ("last-latin", "smith"), ("last-cyrillic", "иванов"), ("email", "ann.lee7@mail3.example.com"), ("email", "иван1@example.com")]
    rows = [(k, n, a) for k, n in rows for a in (0, 1, 2)]
    t = spark.createDataFrame(rows, "kind string, name string, attempt int")
    for r in t.withColumn("s", P.surrogate(F.col("kind"), F.col("name"), F.col("attempt"))).collect():
        assert r["s"] == plain_surrogate(r["kind"], r["name"], r["attempt"])


def test_empty(docs):
    assert P.replace(docs([])).count() == 0
