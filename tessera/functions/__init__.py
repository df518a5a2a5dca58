"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tessera.functions.text import (go_trim, normalize_name, null_tokens_to_null,
                                    split_trim)
from tessera.functions.types import (SEMANTIC_TYPES, guarded_cast, matches_type)
from tessera.functions.sizing import per_column, qcol, stage

__all__ = [
    "go_trim", "normalize_name", "null_tokens_to_null", "split_trim",
    "SEMANTIC_TYPES", "guarded_cast", "matches_type", "per_column", "qcol", "stage",
]
