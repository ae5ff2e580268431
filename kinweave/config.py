"""Parameters of blocking, with the environment variable of the same upper-case name in front of each default."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields

# Words that say what kind of a firm it is.
LEGAL_TERMS = (
    "llc inc ltd limited pvt private corp corporation co company services enterprises holdings group llp pllc sarl sas sa gmbh bv spa "
    "consulting technologies technology international associates solutions industries ventures management development trading"
).split()
# Words of addresses that name no place.
ADDRESS_STOPWORDS = (
    "road street avenue lane drive floor suite block near behind opp opposite post dist district state nagar colony bhavan house north south east west building unit"
).split()
# The rules and their scores.
RULE_SCORES = {
    "exact_name": 100, "core_name": 90, "compact_name": 85, "address_key": 80,
    "rare_token": 70, "token_pair": 60, "minhash_lsh": 50, "prefix_safety_net": 40,
}
ID_PREFIXES = ("S2-", "S3-")


@dataclass(frozen=True)
class BlockingConfig:
    """Bounds on keys, postings and candidates."""

    blocking_max_token_doc_freq: int = 100
    blocking_max_posting_len: int = 250
    blocking_max_rare_tokens_per_s1: int = 3
    blocking_min_token_len: int = 3
    blocking_max_pair_token_freq: int = 1000
    lsh_num_permutations: int = 32
    lsh_num_bands: int = 8
    lsh_shingle_n: int = 3
    lsh_max_bucket_size: int = 100
    lsh_max_candidates: int = 50
    lsh_min_before_fallback: int = 5
    blocking_max_addr_key_freq: int = 50
    blocking_fuzzy_min_cands: int = 3
    blocking_safety_net_max_bucket: int = 30
    blocking_max_candidates_per_s1: int = 250
    blocking_per_shard_candidate_cap: int = 250
    blocking_soft_country_mode: bool = True
    shard_size_targets: int = 2_000_000
    batch_size_s1_queries: int = 25_000
    ram_safety_margin: float = 1.5
    min_free_disk_gb: float = 5.0
    min_free_ram_gb: float = 2.0
    pilot_seed: int = 42
    rules: tuple[str, ...] = field(default=tuple(RULE_SCORES))

    def __post_init__(self) -> None:
        if self.lsh_num_permutations % self.lsh_num_bands:
            raise ValueError("lsh_num_permutations must be a multiple of lsh_num_bands")
        if unknown := set(self.rules) - set(RULE_SCORES):
            raise ValueError(f"unknown rules: {sorted(unknown)}")

    @classmethod
    def from_environment(cls, **more) -> BlockingConfig:
        """Values from the environment, those given here first."""
        got = {}
        for f in fields(cls):
            raw = os.environ.get(f.name.upper())
            if raw is None or f.name == "rules":
                continue
            got[f.name] = raw.strip().lower() in ("1", "true", "yes") if isinstance(f.default, bool) else type(f.default)(raw)
        return cls(**{**got, **more})
