"""The operators' queries: name -> (query, SQL twin or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import alignment, decontaminate, langid, lm, packing, periods, pii, quality, repeats, secrets, simjoin, topk, toxicity
from keelson.llm.common import table


def pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op1(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_harmonic_packing": (pack_documents, None),
    "op2_decontaminate_automaton": (decontaminate.query, decontaminate.SQL),
    "op3_secrets_lexer": (secrets.query, None),
    "op4_column_wise_repeats": (repeats.query, None),
    "op5_backoff_automaton": (lm.query, None),
    "op6_jaccard_divideskip": (simjoin.query, simjoin.SQL),
    "op7_langid_rank_order": (langid.query, None),
    "op8_topk_kdtree": (topk.query, topk.SQL),
    "op9_quality_weak_labels": (quality.query, None),
    "op10_toxicity_counterfactual": (toxicity.query, None),
    "op11_periods_minimizers": (periods.query, None),
    "op12_alignment_lockstep": (alignment.query, None),
    "op13_pii_crf": (pii.query, None),
}
