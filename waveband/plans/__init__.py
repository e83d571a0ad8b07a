"""Jobs and query registry built from the operators."""

from waveband.plans.stages import Run

__all__ = ["Run"]
