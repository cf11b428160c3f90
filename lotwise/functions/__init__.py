"""Scalar column functions (built-in Spark expressions only, codegen-friendly)."""
from .text import *  # noqa: F401,F403
from .price import *  # noqa: F401,F403
from .location import *  # noqa: F401,F403
from .temporal import *  # noqa: F401,F403
