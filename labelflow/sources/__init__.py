from .records import *  # noqa: F401,F403
from .sinks import *  # noqa: F401,F403
from .taxonomy import *  # noqa: F401,F403
