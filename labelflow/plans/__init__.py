from .expansion import *  # noqa: F401,F403
from .flat import *  # noqa: F401,F403
from .prepare import *  # noqa: F401,F403
from .profile import *  # noqa: F401,F403
from .resume import *  # noqa: F401,F403
from .semantic import *  # noqa: F401,F403
from .verified import *  # noqa: F401,F403
