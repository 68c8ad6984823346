"""Column functions on lineages, rank prefixes and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank letters of the classifier column and the prefixes of the lineage string.
RANK_LETTERS = ["d", "k", "p", "c", "o", "f", "g", "s"]


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def primer_hash(forward: Column, reverse: Column) -> Column:
    """First 12 hex digits of the SHA-256 of both primers joined by a bar."""
    return F.substring(F.sha2(F.concat(forward, F.lit("|"), reverse), 256), 1, 12)


def numeric_suffix(identifier: Column) -> Column:
    """Number after the last underscore; 10^9 if it is none."""
    return F.coalesce(F.element_at(F.split(identifier, "_"), -1).try_cast("int"), F.lit(1_000_000_000))


def strip_prefix(value: Column, prefixes: list[str]) -> Column:
    """Value without the first prefix of the list that it starts with; an empty prefix fits all."""
    out = F.when(F.lit(False), value)
    for p in prefixes:
        out = out.when(value.startswith(p), F.substr(value, F.lit(len(p) + 1)))
    return out.otherwise(value)


def parse_assignments(accepted: Column, prefixes: list[str]) -> Column:
    """Map of rank letter to value from ``d:Bacteria,p:Firmicutes``.

    Parts without a colon and parts whose cleaned value is empty are skipped; quotes and one rank
    prefix are taken off. Of repeated letters the last counts.
    """
    parts = F.filter(F.split(F.coalesce(accepted, F.lit("")), ","), lambda t: t.contains(":"))
    clean = lambda t: strip_prefix(F.replace(F.trim(F.regexp_replace(t, "^[^:]*:", "")), F.lit('"'), F.lit("")), prefixes)
    pairs = F.transform(parts, lambda t: F.struct(F.trim(F.substring_index(t, ":", 1)).alias("rank"), clean(t).alias("value")))
    pairs = F.filter(pairs, lambda p: p["value"] != "")
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["rank"] == p["rank"]))
    return F.map_from_entries(last)


def build_lineage(ranks: Column, letters: list[str], prefixes: list[str]) -> Column:
    """Present ranks in order as prefix and value, joined by semicolons; gaps are left out."""
    parts = [F.concat(F.lit(p), F.try_element_at(ranks, F.lit(x))) for x, p in zip(letters, prefixes, strict=True)]
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), ";")


def bare_lineage(values: list[Column], prefixes: list[str], genus: int, species: int) -> Column:
    """Lineage from rank columns without prefixes.

    The species slot needs a genus; a lower-case epithet that doesn't repeat the genus gets it in
    front, anything else is taken as it is. Null and empty values are left out.
    """
    parts = []
    for i, (v, p) in enumerate(zip(values, prefixes, strict=True)):
        present = v.isNotNull() & (v != "")
        if i == species:
            g = values[genus]
            named = F.when(v.rlike("^[a-z]") & ~F.startswith(v, g), F.concat(F.lit(p), g, F.lit(" "), v)).otherwise(F.concat(F.lit(p), v))
            parts.append(F.when(present & g.isNotNull() & (g != ""), named))
        else:
            parts.append(F.when(present, F.concat(F.lit(p), v)))
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), ";")


def full_binomial(lineage: Column) -> Column:
    """Lineage array whose ``s__epithet`` carries its genus, if the epithet is lower-case without it."""
    genus = F.get(F.reverse(F.filter(lineage, lambda x: x.startswith("g__"))), F.lit(0))
    genus = F.when(F.length(genus) > 3, F.substr(genus, F.lit(4)))
    epithet = lambda x: F.substr(x, F.lit(4))
    joins = lambda x: x.startswith("s__") & epithet(x).rlike(r"^\p{Ll}") & genus.isNotNull() & ~F.startswith(epithet(x), F.concat(genus, F.lit(" ")))
    return F.transform(lineage, lambda x: F.when(joins(x), F.concat(F.lit("s__"), genus, F.lit(" "), epithet(x))).otherwise(x))


def segments(lineage: Column) -> Column:
    """Distinct trimmed parts of a lineage string; none for an empty one."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(lineage, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != ""))


def convert_ranked_header(header: Column, letters: list[str]) -> Column:
    """``Bacteria;Firmicutes`` to ``tax=d:Bacteria,p:Firmicutes``: empty parts go, extra ranks too."""
    parts = F.filter(F.transform(F.split(header, ";"), lambda x: F.trim(x)), lambda x: x != "")
    named = F.transform(F.slice(parts, 1, len(letters)), lambda x, i: F.concat(F.element_at(F.array(*[F.lit(c) for c in letters]), i + 1), F.lit(":"), x))
    return F.concat(F.lit("tax="), F.array_join(named, ","))


def convert_root_header(header: Column) -> Column:
    """Header without its accession, ``Root;`` and ``[id: n]`` marks; other shapes raise an error."""
    good = header.rlike("^>[^ ]+ Root;")
    clean = F.regexp_replace(F.regexp_replace(header, "^>[^ ]+ Root;", ">"), r" \[id: \d+\]", "")
    return F.when(good & ~clean.contains("[id:"), clean).otherwise(F.raise_error(F.concat(F.lit("unexpected header: "), header)))


def rrna_header_id(header: Column) -> Column:
    """Sequence id in the header of an rRNA extractor: what precedes the bar in the first word."""
    return F.substring_index(F.element_at(F.split(F.trim(F.regexp_replace(header, "^>", "")), r"\s+"), 1), "|", 1)


def spacer_header_id(header: Column) -> Column:
    """Sequence id in the header of a spacer extractor: the first word of what precedes the bar."""
    return F.element_at(F.split(F.trim(F.substring_index(F.trim(F.regexp_replace(header, "^>", "")), "|", 1)), r"\s+"), 1)


# How report names of the tools become sample names, in order.
RENAMES = [
    (r"^(.+)_R(\d+)_raw$", "QC | raw reads | $1_R$2"), (r"^(.+)_R(\d+)_nophix$", "QC | PhiX-filtered reads | $1_R$2"), (r"^(.+)_R(\d+)_stripped$", "QC | primer-trimmed reads | $1_R$2"),
    (r"^(.+)_phixFilter$", "PhiX removal | $1"), (r"^(.+)_5prime_R\d+$", "Primer trim 5' | $1"), (r"^(.+)_after5p_R\d+$", "Primer trim 5' | $1"), (r"^(.+)_3prime_R\d+$", "Primer trim 3' | $1"), (r"^(.+)_after3p_R\d+$", "Primer trim 3' | $1"),
    (r"^01\.preprocessing \| (.+)$", "Adapter trim | $1"), (r"^02\.classification \| (.+)_report$", "Kraken2 | $1"), (r"^03\.abundance \| (.+)_report$", "Bracken | $1"),
]


def rename_sample(name: Column, rules: list[tuple[str, str]]) -> Column:
    """Apply the renaming patterns one after the other."""
    for pattern, to in rules:
        name = F.regexp_replace(name, pattern, to)
    return name
