"""The corpus pipeline: STAGES, run and ORACLE_SQL are those of `terminus.llm.stages`."""

from terminus.llm.stages import ORACLE_SQL, STAGES, best_fit_packing, language_id, near_dedup, quality_rules, repeat_dedup, run

__all__ = ["ORACLE_SQL", "STAGES", "best_fit_packing", "language_id", "near_dedup", "quality_rules", "repeat_dedup", "run"]
