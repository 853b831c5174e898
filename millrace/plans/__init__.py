from millrace.plans.enriched import ENRICHED, FCT_SALES
from millrace.plans.model import Context, EnrichedModel, ProcessedModel
from millrace.plans.processed import PROCESSED
from millrace.plans.refresh import processed_models, refresh_dependents, run_processed
from millrace.plans.semantic import SemanticModel

__all__ = [
    "ENRICHED",
    "FCT_SALES",
    "PROCESSED",
    "Context",
    "EnrichedModel",
    "ProcessedModel",
    "SemanticModel",
    "processed_models",
    "refresh_dependents",
    "run_processed",
]
