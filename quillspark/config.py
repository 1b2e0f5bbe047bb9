"""All tunable values of the engine in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    bm25_k1: float = 1.5
    bm25_b: float = 0.75
    rrf_k: int = 60
    pool: int = 50
    hybrid: bool = False
    lexical: bool = False
    n_results: int = 5
    max_chunk_chars: int = 2000
    embed_char_budget: int = 1800
    embed_char_hard_cap: int = 2048
    min_width: int = 256
    entity_reserve: int = 200
    header_slack: int = 24
    merge_prose: bool = False
    merge_definitions: bool = False
    overlap_sentences: int = 0
    lead_in_chars: int = 48
    profile_routing: bool = False
    profile_code_share: float = 0.5
    profile_table_share: float = 0.4
    prose_code_share: float = 0.05
    prose_table_share: float = 0.10
    genre_prose_share: float = 0.5
    genre_definition_share: float = 0.5
    genre_questions: int = 2
    genre_modals: int = 2
    keyphrases: int = 6
    keyphrase_words: int = 4
    inventory: bool = True
    confidence: float = 0.6
    vocabulary_min_length: int = 3
    fingerprint_matches: int = 3
    taxonomy_min_docs: int = 2
    lint_leaks: int = 3
    lint_code_share: float = 0.75
    lint_link_share: float = 0.5
    lint_stub_chars: int = 200
    gate: bool = True
    quarantine: bool = True
    max_unrecognised: int = 8
    bucket_size: int = 3
    snippet_chars: int = 600
    coverage_score: float = 0.3
    coverage_chars: int = 400
    language: str = "en"
    default_rate_in: float = 1.0
    default_rate_out: float = 3.0
    chars_per_token: float = 4.0
    eval_floor: float = 0.5
    eval_noise: float = 0.02
    diagram_tolerance: float = 0.5


DEFAULT = Config()
