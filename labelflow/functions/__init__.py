from .text import *  # noqa: F401,F403
