"""Crisis flags from call reports and hospital visits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import vocab as v
from tidemark.functions.text import keyword_flag


def call_flags(primary: str, secondary: str, complaint: str) -> dict[str, Column]:
    """Flags from two impression columns and the chief complaint (column names)."""
    everywhere = lambda patterns: {primary: patterns, secondary: patterns, complaint: patterns}
    suicidal = keyword_flag(
        {**everywhere(v.SUICIDAL_ANYWHERE), complaint: v.SUICIDAL_ANYWHERE + v.SUICIDAL_COMPLAINT},
        {complaint: v.SUICIDAL_VETO},
    )
    pair = F.col(primary).ilike(v.SUICIDAL_PAIR[0]) & F.col(complaint).ilike(v.SUICIDAL_PAIR[1])
    return {
        "suicidal_flag": suicidal | F.coalesce(pair, F.lit(False)),
        "suicide_attempt_flag": keyword_flag({primary: v.ATTEMPT_IMPRESSION, secondary: v.ATTEMPT_IMPRESSION}),
        "drug_flag": keyword_flag({**everywhere(v.DRUG_ANYWHERE), complaint: v.DRUG_ANYWHERE + v.DRUG_COMPLAINT})
        | keyword_flag(everywhere(v.DRUG_ABUSE), {complaint: v.DRUG_ABUSE_VETO}),
        "other_mental_crisis_flag": keyword_flag(everywhere(v.MENTAL_ANYWHERE)),
        "alcohol_flag": keyword_flag(everywhere(v.ALCOHOL_ANYWHERE)),
        "drug_poisoning_flag": keyword_flag(
            everywhere(v.INGEST_ANYWHERE), {primary: v.INGEST_VETO, secondary: v.INGEST_VETO}
        ),
    }


def visit_flags(primary: str, secondary: str, primary_class: Column, secondary_class: Column) -> dict[str, Column]:
    """Flags from primary and secondary diagnosis text and their classes."""
    both = lambda patterns: {primary: patterns, secondary: patterns}
    mental = primary_class.isin(v.MENTAL_CRISIS_CLASSES) | secondary_class.isin(v.MENTAL_CRISIS_CLASSES)
    return {
        "suicide_attempt_flag": keyword_flag(both(v.VISIT_ATTEMPT)),
        "suicidal_flag": keyword_flag(
            {primary: v.VISIT_SUICIDAL, secondary: v.VISIT_SUICIDAL + v.VISIT_SUICIDAL_SECONDARY}
        ),
        "drug_flag": keyword_flag(both(v.VISIT_DRUG)),
        "alcohol_flag": keyword_flag(both(v.VISIT_ALCOHOL)),
        "drug_poisoning_flag": keyword_flag(both(v.VISIT_POISONING)),
        "other_mental_crisis_flag": F.coalesce(mental, F.lit(False)),
    }
