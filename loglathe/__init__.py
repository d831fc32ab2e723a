"""Access-log analytics on Spark: batch and streaming from one set of operators."""

from .functions import *  # noqa: F401,F403
from .functions import __all__ as _functions
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .session import build_session, use_utc
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources
from .store import *  # noqa: F401,F403
from .store import __all__ as _store
from .streaming import *  # noqa: F401,F403
from .streaming import __all__ as _streaming

__all__ = ["build_session", "use_utc", *_functions, *_operators, *_sources, *_store, *_streaming]
