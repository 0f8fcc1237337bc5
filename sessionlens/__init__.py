"""sessionlens: session and funnel analytics as Spark DataFrame operators.

Operators take and return DataFrames (``sessionlens.operators``); the
published models are configurations of them (``sessionlens.plans``).
"""

__version__ = "0.1.0"
