"""Configuration of the pipeline: key=value files and command lines."""

from __future__ import annotations

import argparse
import warnings
from dataclasses import dataclass, field

from .pattern import Kind, Pattern

REQUIRED = ("FORWARD", "OUTPUT", "PATTERN", "MISMATCHES", "SC_ID", "FEATURE_ID")
OPTIONAL = (
    "REVERSE", "FEATURE_NAMES", "ANNOTATION_IDS", "ANNOTATION_NAMES", "UMI_ID", "PREFIX", "BARCODESHARING",
    "STAR", "GENOMEDIR", "THREADS", "INDEPENDENT", "WRITEFAILEDLINES", "WRITESTATS", "HAMMING",
    "FASTQREADBUCKETSIZE", "UMITHRESHOLD", "UMIABUNDANCE", "UMICOLLAPSING", "SC_ID_STRING", "FEATURE",
)
_BOOLEANS = {"1": True, "TRUE": True, "YES": True, "0": False, "FALSE": False, "NO": False}


def parse_ini(text: str) -> dict[str, str]:
    """Keys in capitals; # starts a comment anywhere; unknown keys warn, empty ones are left out."""
    out: dict[str, str] = {}
    for line in text.split("\n"):
        line = line.partition("#")[0].strip()
        if not line:
            continue
        key, sign, value = line.partition("=")
        if not sign:
            raise ValueError(f"not key=value: {line}")
        key, value = key.strip().upper(), value.strip().strip("\"'")
        if key not in REQUIRED + OPTIONAL:
            warnings.warn(f"unknown key {key}", stacklevel=2)
        elif value:
            out[key] = value
    if missing := [k for k in REQUIRED if k not in out]:
        raise ValueError(f"missing keys: {', '.join(missing)}")
    return out


def boolean(text: str) -> bool:
    if text.upper() not in _BOOLEANS:
        raise ValueError(f"not a boolean: {text}")
    return _BOOLEANS[text.upper()]


def integers(text: str | None) -> list[int]:
    return [int(x) for x in (text or "").replace(",", " ").split()]


@dataclass
class PipelineConfig:
    forward: str
    output: str
    pattern: str
    mismatches: str
    cells: list[int]
    feature: int
    reverse: str | None = None
    feature_names: str | None = None
    annotations: list[int] = field(default_factory=list)
    annotation_names: list[str] = field(default_factory=list)
    umi: int | None = None
    prefix: str = ""
    sharing: str | None = None
    alignments: str | None = None
    independent: bool = False
    write_failed: bool = True
    write_stats: bool = True
    hamming: bool = False
    purity: float = 0.0
    abundance: float = 0.2
    collapse: bool = True
    cell_as_string: bool = False
    tag: str = "GX"

    @classmethod
    def from_ini(cls, text: str) -> PipelineConfig:
        c = parse_ini(text)
        flag = lambda k, d: boolean(c[k]) if k in c else d
        return cls(
            c["FORWARD"], c["OUTPUT"], c["PATTERN"], c["MISMATCHES"], integers(c["SC_ID"]), int(c["FEATURE_ID"]),
            c.get("REVERSE"), c.get("FEATURE_NAMES"), integers(c.get("ANNOTATION_IDS")),
            c.get("ANNOTATION_NAMES", "").replace(",", " ").split(), int(c["UMI_ID"]) if "UMI_ID" in c else None,
            c.get("PREFIX", ""), c.get("BARCODESHARING"), None, flag("INDEPENDENT", False), flag("WRITEFAILEDLINES", True),
            flag("WRITESTATS", True), flag("HAMMING", False), float(c.get("UMITHRESHOLD", 0)), float(c.get("UMIABUNDANCE", 0.2)),
            flag("UMICOLLAPSING", True), flag("SC_ID_STRING", False), c.get("FEATURE", "GX"),
        )


def table_column(pattern: Pattern, place: int) -> int:
    """The column, in a table that starts with the read's name, of the element at ``place`` in its pattern."""
    if not 0 <= place < len(pattern.elements) or not pattern.elements[place].emitted:
        raise ValueError(f"element {place} of {pattern.name} has no column")
    return 1 + sum(e.emitted for e in pattern.elements[:place])


def check_same_shape(patterns: list[Pattern]) -> None:
    kinds = [[e.kind for e in p.elements] for p in patterns]
    if any(k != kinds[0] for k in kinds):
        raise ValueError("patterns must be equally long and of equal kinds at each place")
    if sum(k is Kind.RANDOM for k in kinds[0]) > 1:
        raise ValueError("the pipeline takes one random element")


def demultiplex_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("demultiplex")
    a = p.add_argument
    a("-i", "--input", required=True)
    a("-r", "--reverse")
    a("-d", "--independent", type=boolean, default=False)
    a("-o", "--output", required=True)
    a("-n", "--prefix", default="")
    a("-p", "--patterns", required=True)
    a("-m", "--mismatches", required=True)
    a("-t", "--threads", type=int, default=5, help="left to Spark")
    a("-s", "--bucket", type=int, default=0, help="left to Spark")
    a("-q", "--stats", type=boolean, default=False)
    a("-f", "--failed", type=boolean, default=False)
    a("-H", "--hamming", type=boolean, default=False)
    a("-l", "--precalculate-indels", type=boolean, default=True)
    a("-c", "--combine", type=boolean, default=False)
    return p


def count_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("count")
    a = p.add_argument
    a("-i", "--input", required=True)
    a("-o", "--output", required=True)
    a("-d", "--barcode-dir", required=True)
    a("-a", "--feature-names")
    a("-x", "--feature", type=int, required=True)
    a("-g", "--annotation-files", default="")
    a("-y", "--annotations", default="")
    a("-c", "--cells", required=True)
    a("-u", "--umis")
    a("-m", "--umi-mismatches", type=int, default=1)
    a("-H", "--hamming", type=boolean, default=False)
    a("-f", "--purity", type=float, default=0.0)
    a("-v", "--abundance", type=float, default=0.2)
    a("-z", "--collapse", type=boolean, default=True)
    a("-s", "--cell-as-string", type=boolean, default=False)
    a("-w", "--sharing")
    a("-t", "--threads", type=int, default=5, help="left to Spark")
    return p


def annotate_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("annotate")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-b", "--alignments", required=True)
    p.add_argument("-f", "--tag", default="GX")
    return p


def pipeline_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("pipeline")
    p.add_argument("config")
    p.add_argument("--alignments", help="alignments of the DNA parts, made by an external aligner")
    return p
