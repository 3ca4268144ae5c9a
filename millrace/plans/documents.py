"""The text rules once more, over the texts of documents."""

from __future__ import annotations

from . import checks, files, more, texts  # noqa: F401  (they register the queries)
from .base import QUERIES, SQL, Query
from .records import CODES, DOCUMENT_CODES, over_documents

RULES = [
    "bad_pattern_counts", "repetition_features", "structure_violations", "quality_filter", "quality_audit_by_mode", "reject_reason_counts", "geometry_hints", "pedagogical_score", "substantive_features",
    "static_critic", "canonical_document", "last_fenced_block", "token_jaccard", "token_counts", "required_libraries", "required_packages", "dependency_counts", "cleaning_counts", "rendered_prompts",
]


def _over(make: Query) -> Query:
    def query(spark, sf_dir):
        with over_documents():
            return make(spark, sf_dir)

    return query


for _name in RULES:
    QUERIES[f"{_name}_documents"] = _over(QUERIES[_name])
    SQL[f"{_name}_documents"] = SQL[_name].replace(CODES, DOCUMENT_CODES)
