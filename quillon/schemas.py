"""Schemas of the tables."""

from __future__ import annotations

TRIPLES = "onto_id string, s string, s_kind string, p string, o string, o_kind string, o_lang string, o_dtype string"
CATALOG = (
    "acronym string, name string, submission_id bigint, status string, error string, fetched_at string, api_seconds double, "
    "ontology_json string, submission_json string, metrics_json string"
)
DOWNLOADS = (
    "acronym string, submission_id bigint, status string, variant string, http_status int, url string, raw_path string, eval_path string, "
    "bytes bigint, eval_bytes bigint, sha256 string, content_type string, server_filename string, sniffed_format string, archive_type string, "
    "archive_members string, attempts int, started_at string, finished_at string, seconds double, error string, attempts_log string, run_id string"
)
EVALUATIONS = (
    "acronym string, submission_id bigint, status string, attempts int, started_at string, finished_at string, seconds double, error_type string, "
    "error string, traceback string, stage_at_failure string, describe_score double, define_score double, connection_score double, flat_score double, "
    "core_average double, summary_json string, result_path string, entities_path string, parent_peak_rss_mb double, timeout_min double, run_id string"
)
EVENTS = "id bigint, ts string, run_id string, phase string, acronym string, level string, message string"
RUNS = "run_id string, started_at string, finished_at string, phase string, version string, config_json string, env_json string, result_json string"
META = "key string, value string"
SEARCH_BENCHMARK = (
    "id bigint, ts string, run_id string, endpoint string, keyword string, http_status int, seconds double, result_count bigint, "
    "distinct_ontologies bigint, top_ontologies string, error string"
)
SERVING = (
    "provider string, acronym string, name string, description string, categories string, ontology_language string, submission_id bigint, version string, "
    "released string, registry_url string, file_sha256 string, status string, status_detail string, describe_score double, define_score double, "
    "define_bp_score double, define_bp_source string, connection_score double, flat_score double, core_average double, core_average_bp double, "
    "logical_consistency_score double, structural_dist_score double, semantic_dist_score double, triple_count bigint, entity_count bigint, "
    "class_count bigint, source_version string, core_version string, device string, evaluated_at string, updated_at string"
)
HITS = "keyword string, rank int, acronym string, pref_label array<string>, synonym array<string>"
KEYWORD_CACHE = (
    "keyword string, provider string, matches array<struct<acronym: string, relevance: double, hits: bigint, exact: boolean, best_rank: int, "
    "example: string>>, total_hits bigint, fetched_at timestamp"
)
