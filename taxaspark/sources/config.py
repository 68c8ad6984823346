"""Run configuration and marker packs: merging, checking, symbol resolution."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

try:
    import yaml
except ImportError:
    yaml = None


def merge(base: dict, over: dict) -> dict:
    """Overlay: mappings merge key by key, anything else replaces, null too."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(path: str) -> dict:
    text = Path(path).read_text()
    found = json.loads(text) if path.endswith(".json") or yaml is None else yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} isn't a mapping")
    return found


def load_packs(*folders: str) -> dict[str, dict]:
    """Packs by file stem; a file of a later folder replaces the whole pack of the same name."""
    packs = {}
    for folder in folders:
        for p in sorted(Path(folder).glob("*")):
            if p.suffix in (".yaml", ".yml", ".json"):
                packs[p.stem] = load(str(p))
    if not packs:
        raise ValueError("no marker packs")
    return packs


def find_pack(packs: dict[str, dict], marker: str) -> dict:
    for name, pack in packs.items():
        if name.lower() == marker.lower():
            return pack
    raise ValueError(f"unknown marker {marker!r}: {sorted(packs)}")


def reference_path(config: dict, pack: dict, symbol: str, region: str = "") -> str:
    """Path of a reference: the configured one if it is set, else the pack's, with its region filled in."""
    path = config.get("references", {}).get(symbol) or pack.get("references", {}).get(symbol)
    if not path:
        raise ValueError(f"no reference for {symbol!r}")
    return path.replace("{region}", region)


def resource(config: dict, rule: str, what: str, default: int) -> int:
    return int(config.get("resources", {}).get(rule, {}).get(what, default))


# The defaults that change results.
DEFAULTS = {
    "mode": "amplicon",
    "amplicon": {
        "expected_length": "auto", "probe_length_stat": "p95", "min_overlap": 12,
        "cutadapt": {"max_error_rate": 0.2, "min_length": 50},
        "trunc_len": {"q_threshold": 20, "q_floor": 15, "resolve_policy": "raise_trunc", "min_read_coverage_pct": 95},
        "length_filter": {"mode": "auto", "window_margin": 50, "range": None},
        "taxonomy": {"method": "sintax", "min_boot": 80, "sintax_cutoff": 0.8, "filter": {"enabled": True, "keep": None, "discard": None}},
        "dada2": {"max_ee": [2, 5], "trunc_q": 2, "min_len": 20, "max_len": None, "min_overlap": 12, "max_mismatch": 0, "min_fold": 4},
    },
    "shotgun": {
        "kraken": {"confidence": 0.15, "hit_groups": 3},
        "bracken": {"tax_lev": "S", "threshold": "auto", "threshold_alpha": 5e-05, "threshold_min": 10},
        "kmer_evidence": {"enabled": False, "min_distinct": 333, "min_reads": 0, "protect_frac": 0.01},
        "taxonomy_filter": {"enabled": False, "keep": [], "discard": []},
        "extract_taxa": [],
    },
}
RETIRED = {"keep_regex", "discard_regex"}


def validate(config: dict) -> list[str]:
    """Raise for settings that would fail late; returns warnings."""
    warnings = []
    if config.get("mode") not in ("amplicon", "shotgun"):
        raise ValueError("mode is amplicon or shotgun")
    shot, amp = config.get("shotgun", {}), config.get("amplicon", {})
    br, ev = shot.get("bracken", {}), shot.get("kmer_evidence", {})
    if not 0 < br.get("threshold_alpha", 5e-05) < 1:
        raise ValueError("threshold_alpha lies between 0 and 1")
    if br.get("threshold", "auto") != "auto" and br["threshold"] < 0:
        raise ValueError("threshold isn't negative")
    if not 0 < ev.get("protect_frac", 0.01) <= 1 or ev.get("min_distinct", 0) < 0 or ev.get("min_reads", 0) < 0:
        raise ValueError("protect_frac lies in (0, 1], the floors aren't negative")
    if ev.get("enabled") and br.get("tax_lev", "S") != "S":
        warnings.append("the evidence gate works best on species")
    tax = amp.get("taxonomy", {})
    if RETIRED & (set(tax.get("filter", {})) | set(shot.get("taxonomy_filter", {}))):
        raise ValueError("regex filters are retired: list whole lineage segments")
    ranks, prefixes = tax.get("ranks"), tax.get("prefixes")
    if ranks and prefixes and len(ranks) != len(prefixes):
        raise ValueError("ranks and prefixes have different lengths")
    if tax.get("method", "sintax") not in ("sintax", "rdp"):
        raise ValueError("taxonomy.method is sintax or rdp")
    span = amp.get("length_filter", {}).get("range")
    if span is not None and (len(span) != 2 or span[0] > span[1]):
        raise ValueError("length_filter.range has two rising ends")
    return warnings


@dataclass
class Marker:
    """Facts about a marker that a pack gives."""

    name: str
    ranks: list[str] = field(default_factory=list)
    prefixes: list[str] = field(default_factory=list)
    truncates: bool = True

    @classmethod
    def of(cls, name: str, pack: dict) -> Marker:
        ranks, prefixes = list(pack.get("ranks", [])), list(pack.get("prefixes", []))
        if len(ranks) != len(prefixes):
            raise ValueError(f"pack {name}: ranks and prefixes have different lengths")
        return cls(name, ranks, prefixes, name.upper() != "ITS")
