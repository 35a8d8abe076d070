"""refillscope: medication-adherence analytics expressed as Spark DataFrame plans.

Dispensing records go in; per (product, patient) delivery gaps, summaries and an
adherence percentage come out. Every step is a DataFrame transformation keyed by
``(prod, patient_id)``; nothing is collected to the driver.
"""

from refillscope.schema import CANONICAL_KEYS

__all__ = ["CANONICAL_KEYS"]
__version__ = "0.1.0"
