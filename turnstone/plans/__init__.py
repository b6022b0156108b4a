"""Registered named queries; importing this package fills ``REGISTRY``."""

from turnstone.plans.registry import REGISTRY  # noqa: F401
from turnstone.plans import kpi_queries  # noqa: F401
from turnstone.plans import feature_queries  # noqa: F401
from turnstone.plans import audit_queries  # noqa: F401
from turnstone.plans import log_queries  # noqa: F401
from turnstone.plans import eval_queries  # noqa: F401
from turnstone.plans import explain_queries  # noqa: F401
from turnstone.plans import resample_queries  # noqa: F401
from turnstone.plans import model_queries  # noqa: F401
from turnstone.plans import causal_queries  # noqa: F401
from turnstone.plans import io_queries  # noqa: F401
