"""All registered queries.  Importing the family modules fills the registry."""

from txnscope.catalog.registry import QUERIES, ORACLES  # noqa: F401
from txnscope.catalog import q_history, q_metrics, q_parse, q_quality, q_profile, q_prep, q_segments, q_resample, q_stream, q_models, q_lifecycle, q_files, q_extra  # noqa: F401
