"""The registered queries."""

from . import q_comps, q_models, q_relational, q_rolls, q_scalar, q_series, q_sites, q_stream, registry

__all__ = ["q_comps", "q_models", "q_relational", "q_rolls", "q_scalar", "q_series", "q_sites", "q_stream", "registry"]
