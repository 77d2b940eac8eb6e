from growthlens.plans.pipeline import build_warehouse
from growthlens.plans.relations import Relations

__all__ = ["Relations", "build_warehouse"]
