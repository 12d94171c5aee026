"""Configuration files, read on the driver and checked."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

MODES = ("rules", "folder")


@dataclass
class Attack:
    name: str
    rules: list[dict] = field(default_factory=list)


@dataclass
class Config:
    mode: str
    output_dir: str
    neg_sampling_rate: float
    attacks: list[Attack]
    pos_glob: str | None = None
    neg_glob: str | None = None
    shared_neg_pcap: str | None = None
    pretrain_neg_glob: str | None = None
    shared_pretrain_neg_pcap: str | None = None
    raw_pcap: str | None = None
    write_mixed_pcap: bool = True


def _required(d: dict, key: str, where: str):
    if key not in d:
        raise ValueError(f"{where}: {key} is missing")
    return d[key]


def load_config(path: str) -> Config:
    """A job configuration; a missing required field is an error, missing optional ones are None, and mixed captures default to true."""
    with open(path) as f:
        d = json.load(f)
    g = _required(d, "global", path)
    attacks = []
    for a in _required(d, "attacks", path):
        rules = _required(a, "rules", "attack")
        for r in rules:
            for k in ("attackers", "start_time", "end_time", "attack_type"):
                _required(r, k, "rule")
        attacks.append(Attack(_required(a, "name", "attack"), rules))
    mixed = g.get("write_mixed_pcap")
    optional = {k: g.get(k) for k in ("pos_glob", "neg_glob", "shared_neg_pcap", "pretrain_neg_glob", "shared_pretrain_neg_pcap", "raw_pcap")}
    return Config(_required(g, "mode", "global"), _required(g, "output_dir", "global"), float(_required(g, "neg_sampling_rate", "global")), attacks, write_mixed_pcap=True if mixed is None else mixed, **optional)


@dataclass
class Dataset:
    name: str
    sources: list[str]
    rules: str | None = None
    timezone_offset: int = 0


def load_stats_config(path: str) -> list[Dataset]:
    with open(path) as f:
        return [Dataset(_required(d, "name", path), _required(d, "sources", path), d.get("rules"), d.get("timezone_offset") or 0) for d in json.load(f)]
