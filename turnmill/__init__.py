"""Preparation of chat-training data as Spark jobs."""

from turnmill.config import CHATML, PLAIN, ChatTemplate, GenerationParams, PrepareConfig
from turnmill.functions.chat import concat_messages, model_prompt, render_chat
from turnmill.functions.checks import content_rules, validate_messages, validate_messages_json
from turnmill.functions.counters import arrow_counter
from turnmill.functions.pairs import is_valid_pair, pair_messages
from turnmill.functions.pii import redact_pii
from turnmill.functions.text import clean_text
from turnmill.operators.adapt import pairs_to_messages, turns_to_messages, turns_to_pairs, with_row_key
from turnmill.operators.evals import assemble_results, eval_by_category, eval_preview, eval_prompts, eval_summary, first_responses, unmatched_responses
from turnmill.operators.filters import filter_long, filter_valid, skip_counts, skip_reasons, word_count
from turnmill.operators.issues import InvalidSamples, assert_valid, schema_issues, schema_issues_json, schema_report
from turnmill.operators.order import number_rows, preview, seeded_layout, seeded_order, smoke_sample
from turnmill.operators.redact import pii_counts, redact_messages
from turnmill.operators.split import split_counts, split_exact, split_hash
from turnmill.operators.stats import dataset_stats, source_profile
from turnmill.plans.curate import curate
from turnmill.plans.evaluate import write_results
from turnmill.plans.prepare import PrepareReport, prepare, prepare_to_jsonl
from turnmill.sinks.jsonl import write_jsonl, write_records, write_splits
from turnmill.sinks.publish import Published, publish_splits, published
from turnmill.sources.jsonl import load_splits, quarantine_jsonl, read_eval_prompts, read_jsonl, read_lines, read_records, union_splits
from turnmill.sources.pairs import pick_split, read_pairs
from turnmill.streaming.curate import curate_pairs, read_files, write_files

__all__ = [name for name in dir() if not name.startswith("_")]
