"""Column-expression builders: everything here returns a native ``Column`` or
a SQL boolean string, so it stays inside whole-stage codegen."""

from strata_engine.functions.casts import id_suffix, lossless, safe_cast
from strata_engine.functions.codes import code_label
from strata_engine.functions.hashing import hash_hex, unit_hash
from strata_engine.functions import rules

__all__ = [
    "code_label",
    "hash_hex",
    "id_suffix",
    "lossless",
    "rules",
    "safe_cast",
    "unit_hash",
]
