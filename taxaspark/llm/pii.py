"""Surrogates for personal data, with SQL functions alone.

Entities are found by one pattern; every entity gets a keyed surrogate of its own kind: digits stay
digits and letters letters of their script, separators and letter case stay as written, country codes stay, check digits
of cards and IBANs stay right, and names keep gender and script. An entity has one surrogate wherever it is
written. Names are replaced word by word, a family name by one surrogate whatever stands before it, so "Mr John
Smith" and "Mrs Smith" stay a family; where a form of address has told a name, the text's other
mentions of it are replaced too. Not so where the word alone may be no name: a common word (``COMMON``), one that the text
also writes small, one before a year. With a form of address or the rest of its name it is replaced even then. A
possessive 's stays behind the surrogate, initials stay as they are, a name has at most 32 words. The distinct entities of all documents are checked against each other: no two share a
surrogate and no surrogate is another's original; those that collide draw again until none does.

Formats that hold few values grow where they run out: from the fourth draw on, e-mail names get further letters and
IPv4 addresses come from reserved ranges, then from all.

Not found: names in texts that never put a form of address before them, names in capitals, scripts
other than Latin and Cyrillic, common words that stand for a person alone, addresses and dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import cut, fits, join_checked, let, text_key

KEY = "surrogate-1"

# Forms of address by the gender they tell, in the languages of the corpus.
MALE = "Mr|Sir|Herr|Herrn|Monsieur|Señor|Sr|Г-н|г-н|Господин|господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Г-жа|г-жа|Госпожа|госпожа"
EITHER = "Dr|Doctor|Doktor|Docteur|Prof|Professor|Professeur|Д-р|Доктор|Профессор|профессор"
# Words that stand within a name as they are.
PARTICLES = "von|van|vom|zu|zum|zur|de|der|den|del|della|di|da|du|des|la|le|ter|ten"
# Family names that are common words and often open a sentence or a title, in the languages of the corpus; alone they may be no name.
COMMON = (
    "April August May March June July Mai Mars Juni Juli Januar Enero Mayo Summer Winter Sommer Herbst Spring Day Page "
    "Young Old Long Short Small Little Good Best Rich Poor Strong Wise Sharp Swift Bright Early Major Black White Brown Green Gray Grey Blue Gold Silver "
    "Klein Gross Groß Lang Lange Kurz Jung Alt Neu Schwarz Weiss Weiß Braun Roth Reich Stark Blanc Noir Petit Grand Rey Blanco Bueno Delgado Rojo "
    "King Prince Bishop Pope Hunter Field Fields Forest Hill Hills Lake Park Rivers Stone Wood Woods Church House Hall Street Gates Bridges Banks "
    "Love Hope Joy Power Price Case Cash Chance Grant Bill Mark Will Rose Frost Snow Rain Bush Bell Ball Book Bond Cross Else"
).split()
# Surrogate given names by gender and script; family names are a stem and an ending.
FIRST = {
    "male-latin": "Adrian Bruno Carl David Emil Felix Gustav Hugo Ivan Jonas Karl Leo Martin Nils Oscar Paul Rafael Simon Thomas Victor".split(),
    "female-latin": "Alma Berta Clara Diana Elena Frida Greta Hanna Irene Julia Klara Lena Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
    "male-cyrillic": "Андрей Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман Сергей Тимур Фёдор".split(),
    "female-cyrillic": "Алла Вера Галина Дарья Елена Жанна Зоя Инна Клара Лидия Мария Нина Ольга Полина Раиса София Тамара Юлия".split(),
}
FIRST |= {f"either-{script}": FIRST[f"male-{script}"] + FIRST[f"female-{script}"] for script in ("latin", "cyrillic")}
LAST = {
    "latin": ("Ad Bal Con Dor El Fel Gar Han Ib Jan Kel Lor Mar Nor Ol Per Quin Ros San Tor Ul Vid Wel Zan".split(), "ler den ti val gel man sen ero ard ker mann ström ini ette ley son etti ik well berg".split()),
    "cyrillic": ("Бел Волк Гром Дрозд Еж Жук Зим Исай Кот Лап Мороз Нос Орл Рык Сед Тит Увар Фом Шил Ястреб".split(), "ов ев ин".split()),
}
# The country codes of telephone numbers that have one or two digits; all others have three.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# Letters to draw from, by script.
LETTERS = {"Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Latin": "abcdefghijklmnopqrstuvwxyz"}

EMAIL = r"(?<![\p{L}\p{N}_.+-])[\p{L}\p{N}_.+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
ADDRESS = r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"
ADDRESS6 = r"(?<![\p{L}\p{N}:.])(?=[a-fA-F:]*[0-9])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\p{L}\p{N}:])"
TOKEN = r"(?<![\p{L}\p{N}])(?=[0-9a-fA-F]{0,31}[0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])"
PHONE = r"(?<![\p{L}\p{N}])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])|(?<![\p{L}\p{N}.])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![\p{L}\p{N}.-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])|(?<![\p{L}\p{N}.+/-])(?=0(?:[ /-]?[0-9]){7,14}(?![0-9]))0[0-9]{1,4}[ /-][0-9]{3,8}(?:[ -][0-9]{2,6}){0,2}(?![0-9-])"
NATIONAL = r"(?<![\p{L}\p{N}.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![\p{L}\p{N}.])[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}0-9])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
# Capitals and apostrophes within a word (O'Brien, McDonald), but no 's behind it; an initial goes with the name it stands before.
PIECE = r"\p{Lu}(?:['’]?\p{Lu}|['’](?=\p{Ll}{2}))?\p{Ll}++(?:['’]?\p{Lu}\p{Ll}++|['’](?!(?:ll|re|ve)(?!\p{L}))\p{Ll}{2,}+){0,4}"
WORD = rf"{PIECE}(?:-{PIECE}){{0,4}}"
INITIAL = r"\p{Lu}\.? "
TITLE = rf"(?:{MALE}|{FEMALE}|{EITHER})\.? "
BEFORE = rf"(?:(?:(?:{PARTICLES}) )|{INITIAL}){{0,4}}"
NAME = rf"(?<![\p{{L}}\p{{N}}]){TITLE}{BEFORE}{WORD}(?: {BEFORE}{WORD}){{0,31}}"
PATTERN = "|".join([EMAIL, ADDRESS, ADDRESS6, TOKEN, IBAN, PHONE, NATIONAL, CARD, NAME])


def kind_of(mention: Column) -> Column:
    """Kind of a mention that ``PATTERN`` found."""
    gender = F.when(mention.rlike(rf"^(?:{MALE})\.? "), "male").when(mention.rlike(rf"^(?:{FEMALE})\.? "), "female").otherwise("either")
    return (
        F.when(mention.contains("@"), "email")
        .when(mention.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), "ip")
        .when(mention.rlike(r"^[0-9a-fA-F]*:[0-9a-fA-F:]+$"), "ip6")
        .when(mention.rlike(r"^[0-9a-fA-F]{32,}$"), "token")
        .when(mention.rlike(r"^[A-Z]{2}[0-9]{2}"), "iban")
        .when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "national")
        .when(mention.rlike(r"^(?:\+|\(|0[0-9]{1,4}[ /-][0-9]{3,8}(?: |-|$)|[0-9]{3}-[0-9]{3}-[0-9]{4}$)"), "phone")
        .when(mention.rlike(r"^[0-9]"), "card")
        .otherwise(F.concat(gender, F.when(mention.rlike(r"\p{IsCyrillic}+$"), "-cyrillic").otherwise("-latin")))
    )


def canonical(kind: Column, mention: Column) -> Column:
    """What is the same however the entity (other than a name) is written."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    return (
        F.when(kind.isin("email", "token", "ip", "ip6"), F.lower(mention))
        .when(kind == "phone", F.concat(F.when(mention.startswith("+"), "+").otherwise(""), digits))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .otherwise(digits)
    )


def stays(word: Column) -> Column:
    """True for words of a name that aren't replaced: particles and initials."""
    return word.isin(PARTICLES.split("|")) | word.rlike(r"^\p{Lu}\.?$")


def is_name(kind: Column) -> Column:
    return kind.rlike("^(?:male|female|either|first|last)-")


def _parts(kind: Column, mention: Column) -> Column:
    """Entities of a mention: itself, or the words of a name; kind, name, word, tail (an ending that is no part of the name) and what follows it in the mention."""
    words = F.split(F.regexp_replace(mention, rf"^{TITLE}", ""), " ")

    def word(x: Column, i: Column, n: Column, all_: Column) -> Column:
        last = i == n - 1
        # Family names of women in -ова, -ева, -ина are those of men with an ending.
        tail = F.when(last & (kind == "female-cyrillic") & x.rlike("[оеиы][вн]а$"), "а").otherwise("")
        script = F.substring_index(kind, "-", -1)
        own = F.when(last, F.concat(F.lit("last-"), script)).otherwise(F.concat(F.lit("first-"), kind))
        return F.struct(own.alias("kind"), F.lower(F.substr(x, F.lit(1), F.length(x) - F.length(tail))).alias("name"), x.alias("word"), tail.alias("tail"), F.array_join(F.slice(all_, i + 2, F.greatest(n - i - 1, F.lit(0))), " ").alias("rest"))

    named = let(words, lambda w: F.filter(F.transform(w, lambda x, i: word(x, i, F.size(w), w)), lambda e: ~stays(e["word"])))
    alone = F.array(F.struct(kind.alias("kind"), canonical(kind, mention).alias("name"), mention.alias("word"), F.lit("").alias("tail"), F.lit("").alias("rest")))
    return F.when(is_name(kind), named).otherwise(alone)


def _stream(kind: Column, name: Column, attempt: Column, key: str) -> Column:
    seed = F.concat_ws("\u0001", F.lit(key), kind, attempt.cast("string"), name)
    return F.concat(F.sha2(seed, 256), F.sha2(F.concat(F.lit("2"), seed), 256))


def _number(stream: Column, i: Column, base: int) -> Column:
    """The i-th draw of the stream, below ``base``."""
    return (F.conv(F.substr(stream, F.pmod(i * 5, F.lit(121)) + 1, F.lit(4)), 16, 10).cast("int") % base).cast("int")


def _letter(stream: Column, i: Column, script: str) -> Column:
    return F.substr(F.lit(LETTERS[script]), _number(stream, i, len(LETTERS[script])) + 1, F.lit(1))


def _like(text: Column, stream: Column) -> Column:
    """Digits for digits and letters of their script for letters (lower case), other characters as they are."""
    letter = lambda c, i: F.when(c.rlike(r"\p{IsCyrillic}"), _letter(stream, i, "Cyrillic")).when(c.rlike(r"\p{IsGreek}"), _letter(stream, i, "Greek")).otherwise(_letter(stream, i, "Latin"))
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike("[0-9]"), _number(stream, i, 10).cast("string")).when(c.rlike(r"\p{L}"), letter(c, i)).otherwise(c)), "")


def _digits(text: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike("[0-9]"), _number(stream, i, 10).cast("string")).otherwise(c)), "")


def _pick(values: list[str], stream: Column, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _number(stream, i, len(values)) + 1)


def luhn(digits: Column) -> Column:
    """Sum of a card number's digits, every second from the right doubled; right numbers have a multiple of ten."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: (F.ascii(c) - 48) * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))


def mod97(text: Column) -> Column:
    """Remainder of an IBAN's characters read as one number, letters as 10 to 35."""
    return F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: F.when(c < ":", (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97))


def surrogate(kind: Column, name: Column, attempt: Column, key: str = KEY) -> Column:
    """Canonical form of the surrogate of an entity."""
    return let(_stream(kind, name, attempt, key), lambda s: _surrogate(kind, name, attempt, key, s))


def _surrogate(kind: Column, name: Column, attempt: Column, key: str, s: Column) -> Column:
    local, domain = F.substring_index(name, "@", 1), F.substring_index(name, "@", -1)
    host = F.concat(F.lit("mx"), F.substring(F.sha2(F.concat(F.lit(key + "@"), domain), 256), 1, 6), F.lit(".example.org"))
    more = F.when(attempt < 3, "").otherwise(F.translate(F.substr(s, F.lit(64), attempt - 2), "0123456789", "ghijklmnop"))
    hexed = F.array_join(F.transform(F.split(name, ""), lambda c, i: F.when(c.rlike("[0-9]"), _number(s, i, 10).cast("string")).otherwise(F.substr(F.lit("abcdef"), _number(s, i, 6) + 1, F.lit(1)))), "")
    net = F.when(attempt < 3, F.lit(10)).when(attempt < 8, 240 + _number(s, F.lit(4), 15)).otherwise(1 + _number(s, F.lit(4), 223))
    octets = F.concat_ws(".", net.cast("string"), *[_number(s, F.lit(i), 256).cast("string") for i in (1, 2, 3)])
    groups = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(s, 5 * i + 1, 4) for i in range(6)])
    code = F.when(name.startswith("+"), F.regexp_extract(name, COUNTRY, 0)).when(name.startswith("0"), "0").otherwise("")
    phone = F.concat(code, _digits(F.substr(name, F.length(code) + 1), s))
    # The first digit tells the issuer; the last is the check digit of numbers that had a right one.
    body = F.concat(F.substring(name, 1, 1), _digits(F.substr(name, F.lit(2), F.length(name) - 2), s))
    check = F.when(luhn(name) % 10 == 0, (10 - luhn(F.concat(body, F.lit("0"))) % 10) % 10).otherwise(_number(s, F.length(name), 10))
    account = F.upper(_like(F.substr(name, F.lit(5)), s))
    iban = let(account, lambda a: F.concat(F.substring(name, 1, 2), F.lpad((98 - mod97(F.concat(a, F.substring(name, 1, 2), F.lit("00")))).cast("string"), 2, "0"), a))
    out = (
        F.when(kind == "email", F.concat(_like(local, s), more, F.lit("@"), host))
        .when(kind == "ip", octets)
        .when(kind == "ip6", groups)
        .when(kind == "token", hexed)
        .when(kind == "iban", iban)
        .when(kind == "phone", phone)
        .when(kind == "national", _digits(name, s))
        .when(kind == "card", F.concat(body, check.cast("string")))
    )
    # Every further attempt adds a part to a name, so names can't run out.
    times = F.sequence(F.lit(0), attempt)
    for k, values in FIRST.items():
        out = out.when(kind == f"first-{k}", F.lower(F.array_join(F.transform(times, _picker(values, s)), "-")))
    for k, (stems, endings) in LAST.items():
        out = out.when(kind == f"last-{k}", F.lower(F.array_join(F.transform(times, _picker([a + b for a in stems for b in endings], s)), "-")))
    return out


def _picker(values: list[str], stream: Column):
    return lambda i: _pick(values, stream, i + 3)


def render(kind: Column, mention: Column, parts: Column) -> Column:
    """The surrogate written as the mention is: separators, letter case, form of address and particles stay.

    ``parts`` are the mention's entities with their surrogates in ``found``.
    """
    first = F.element_at(parts, 1)["found"]
    return F.when(is_name(kind), _named(mention, parts)).otherwise(let(first, lambda own: let(F.regexp_replace(own, r"[^0-9]", ""), lambda digits: _rendered(kind, mention, own, digits))))


def _capitalised(name: Column) -> Column:
    return F.replace(F.initcap(F.replace(name, F.lit("-"), F.lit("- "))), F.lit("- "), F.lit("-"))


def _named(mention: Column, parts: Column) -> Column:
    written = F.transform(parts, lambda e: F.struct(e["word"].alias("word"), F.concat(_capitalised(e["found"]), e["tail"]).alias("to")))
    words = F.split(F.regexp_replace(mention, rf"^{TITLE}", ""), " ")
    # The k-th word that doesn't stay is the k-th part.
    at = lambda all_, i: F.size(F.filter(F.slice(all_, F.lit(1), i + 1), lambda x: ~stays(x)))
    return F.concat(F.regexp_extract(mention, rf"^{TITLE}", 0), F.array_join(let(words, lambda w: F.transform(w, lambda x, i: F.when(stays(x), x).otherwise(F.get(written, at(w, i) - 1)["to"]))), " "))


def _rendered(kind: Column, mention: Column, found: Column, digits: Column) -> Column:
    at = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), r"[^0-9]", ""))
    spaced = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substr(digits, at(i), F.lit(1))).otherwise(c)), "")
    place = lambda i: F.length(F.replace(F.substr(mention, F.lit(1), i + 1), F.lit(" "), F.lit("")))
    grouped = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(found, place(i), F.lit(1)))), "")
    return (
        F.when(kind.isin("phone", "national", "card"), spaced)
        .when(kind == "iban", grouped)
        .when(kind.isin("email", "token", "ip6"), F.when(mention == F.upper(mention), F.upper(found)).otherwise(found))
        .otherwise(found)
    )


def _detailed(found: Column) -> Column:
    kinds = F.transform(found, lambda m: F.struct(kind_of(m).alias("kind"), m.alias("mention")))
    return F.transform(kinds, lambda m: F.struct(m["kind"].alias("kind"), m["mention"].alias("mention"), _parts(m["kind"], m["mention"]).alias("parts")))


def with_mentions(rows: DataFrame) -> DataFrame:
    """Add ``mentions`` (kind, mention, parts, in text order) and ``pattern`` (what finds them) to ``rows`` with text.

    ``pattern`` is null for texts without a form of address; in the others it also finds the names told by these where they stand alone.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    likely = text.rlike(rf"[0-9@]|{TITLE}")
    rows = rows.withColumn("mentions", F.when(likely, _detailed(F.regexp_extract_all(text, F.lit(PATTERN), 0))).otherwise(_detailed(F.array().cast("array<string>"))))
    told = F.flatten(F.transform(F.filter("mentions", lambda m: is_name(m["kind"])), lambda m: m["parts"]))
    # A given name alone may be any word; with the rest of its name behind it, it is the name.
    end = F.lit(r"(?![\p{L}\p{N}])")
    small = lambda w: F.contains(text, F.lower(w)) & F.rlike(text, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), F.lower(w), end))
    clear = lambda e: (e["rest"] != "") | ~(e["word"].isin(COMMON) | small(e["word"]))
    alone = lambda e: F.concat(e["word"], F.when(e["rest"] != "", F.concat(F.lit("(?= "), F.replace(e["rest"], F.lit("."), F.lit("[.]")), end, F.lit(")"))).otherwise(F.concat(end, F.lit("(?! [12][0-9]{3}(?![0-9]))"))))
    rows = rows.withColumn("told", told).withColumn("alone", F.array_distinct(F.transform(F.filter("told", clear), alone)))
    more = F.when(F.size("alone") > 0, F.concat(F.lit(r"|(?<![\p{L}\p{N}])(?:"), F.array_join("alone", "|"), F.lit(")"))).otherwise("")
    rows = rows.withColumn("pattern", F.when(F.size("told") > 0, F.concat(F.lit(PATTERN), more))).drop("alone")
    again = F.transform(F.regexp_extract_all(text, F.col("pattern"), F.lit(0)), lambda m: let(F.get(F.filter("told", lambda e: e["word"] == m), F.lit(0)), lambda e: F.when(e.isNotNull() & ~m.contains(" "), F.struct(e["kind"].alias("kind"), m.alias("mention"), F.array(e).alias("parts")))))
    whole = F.zip_with(again, _detailed(F.regexp_extract_all(text, F.col("pattern"), F.lit(0))), lambda a, b: F.coalesce(a, b))
    return rows.withColumn("mentions", F.when(F.col("pattern").isNotNull(), whole).otherwise(F.col("mentions"))).drop("told")


def collisions(entities: DataFrame, key: str = KEY, rounds: int = 50) -> DataFrame:
    """kind, name, attempt of the entities whose first surrogate collides.

    ``entities`` has the distinct (kind, name). In each round an undecided entity keeps its draw if
    it is the smallest of those that drew the same, nobody had it before, and it is no original.
    """
    drawn = cut(entities.select("kind", "name", F.lit(0).alias("attempt"), surrogate(F.col("kind"), F.col("name"), F.lit(0), key).alias("found")))
    originals = entities.select("kind", F.col("name").alias("found"))

    def undecided(rows: DataFrame, taken: DataFrame | None) -> DataFrame:
        first = rows.groupBy("kind", "found").agg(F.min("name").alias("_first"), F.count("*").alias("_n"))
        bad = first.join(originals.unionByName(taken) if taken is not None else originals, ["kind", "found"], "left_semi").select("kind", "found", F.lit(True).alias("_bad"))
        doubtful = first.join(bad, ["kind", "found"], "left").where("_n > 1 OR _bad")
        met = join_checked(rows, doubtful, ["kind", "found"], "inner", 500_000)
        return cut(met.where("_bad OR name <> _first").select("kind", "name", F.lit(0).alias("attempt")).distinct())

    left, settled = undecided(drawn, None), None
    taken = drawn.join(left.select("kind", "name"), ["kind", "name"], "left_anti").select("kind", "found")
    for attempt in range(1, rounds):
        if not left.limit(1).count():
            break
        again = cut(left.select("kind", "name", F.lit(attempt).alias("attempt"), surrogate(F.col("kind"), F.col("name"), F.lit(attempt), key).alias("found")))
        left = undecided(again, taken)
        done = again.join(left.select("kind", "name"), ["kind", "name"], "left_anti")
        settled = done.select("kind", "name", "attempt") if settled is None else settled.unionByName(done.select("kind", "name", "attempt"))
        taken = cut(taken.unionByName(done.select("kind", "found")))
    else:
        raise ValueError("surrogates still collide: there are more entities of a kind than surrogates")
    if settled is None:
        return left
    return cut(settled)


def replace(docs: DataFrame, key: str = KEY, max_overrides: int = 500_000) -> DataFrame:
    """doc_id, text (with surrogates), n_entities, entities for every row of ``docs``.

    ``entities`` lists kind, surrogate and the hash of the original, in text order. Null texts stay
    null and have none; repeated rows give repeated results; columns other than doc_id and text
    are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("k", text_key(F.col("text")))
    found = with_mentions(rows.select("k", "text")).select("k", F.explode(F.flatten(F.transform("mentions", lambda m: m["parts"]))).alias("e")).select("k", "e.kind", "e.name")
    seen = cut(found.distinct())
    over = cut(collisions(seen.select("kind", "name").distinct(), key))
    # Which texts name an entity that had to draw again.
    near = join_checked(seen, over, ["kind", "name"], "inner", max_overrides).groupBy("k")
    near = cut(near.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "name"), "attempt"))).alias("over")))
    rows = with_mentions(rows.join(F.broadcast(near) if fits(near, max_overrides) else near, "k", "left"))
    attempt = lambda e: F.coalesce(F.try_element_at("over", F.concat_ws(":", e["kind"], e["name"])), F.lit(0))
    drawn = lambda m: F.transform(m["parts"], lambda e: F.struct(e["word"].alias("word"), e["tail"].alias("tail"), surrogate(e["kind"], e["name"], attempt(e), key).alias("found")))
    hashed = lambda m: F.substring(F.sha2(F.concat(F.lit(key), F.array_join(F.transform(m["parts"], lambda e: e["name"]), " ")), 256), 1, 16)
    said = F.transform("mentions", lambda m: F.struct(m["kind"].alias("kind"), render(m["kind"], m["mention"], drawn(m)).alias("surrogate"), hashed(m).alias("original_hash")))
    rows = rows.withColumn("entities", said)
    parts = F.when(F.col("pattern").isNull(), F.split("text", PATTERN, -1)).otherwise(F.split("text", F.col("pattern"), -1))
    spliced = F.array_join(F.flatten(F.transform(parts, lambda p, i: F.array(p, F.coalesce(F.get("entities", i)["surrogate"], F.lit(""))))), "")
    text = F.when(F.size("entities") > 0, spliced).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"), F.size("entities").alias("n_entities"), "entities")
