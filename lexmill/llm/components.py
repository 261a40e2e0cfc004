"""Connected components, as the retrieval operators use them too."""

from __future__ import annotations

from lexmill.plans.components import connected_components

__all__ = ["connected_components"]
