from .cells import *  # noqa: F401,F403
from .clusters import *  # noqa: F401,F403
from .correlation import *  # noqa: F401,F403
from .dedup import *  # noqa: F401,F403
from .fuzzy import *  # noqa: F401,F403
from .hierarchy import *  # noqa: F401,F403
from .keywords import *  # noqa: F401,F403
from .lookup import *  # noqa: F401,F403
from .numbering import *  # noqa: F401,F403
from .relations import *  # noqa: F401,F403
from .replies import *  # noqa: F401,F403
from .similarity import *  # noqa: F401,F403
from .sketches import *  # noqa: F401,F403
from .skew import *  # noqa: F401,F403
from .stats import *  # noqa: F401,F403
from .taxonomy import *  # noqa: F401,F403
from .token_join import *  # noqa: F401,F403
from .vectors import *  # noqa: F401,F403
