"""Rolls of members, cleaned, reconciled and analysed on Spark.

functions   scalar column expressions
operators   DataFrame to DataFrame
sources     readers and writers
streaming   the live feed
plans       derived views, registered queries, their SQL
llm         operations of a training-data pipeline; nothing else imports it
"""

from rosterloom.functions.rules import Rule, rewrite, rules_for
from rosterloom.operators.lookup import assign_sites, nearest_site
from rosterloom.operators.parse import page_quality, parse_lines, records, rejects
from rosterloom.operators.reconcile import correct_by_history, hybrid_roll, survive, vote
from rosterloom.operators.registry import Pipeline, Registry

__all__ = ["Pipeline", "Registry", "Rule", "assign_sites", "correct_by_history", "hybrid_roll", "nearest_site", "page_quality", "parse_lines", "records", "rejects", "rewrite", "rules_for", "survive", "vote"]
