"""Column-expression helpers (all JVM-side, codegen-friendly)."""
from .exprs import *  # noqa: F401,F403
