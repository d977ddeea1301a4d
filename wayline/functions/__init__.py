"""Column -> Column helpers."""

from wayline.functions.casts import *  # noqa: F401,F403
from wayline.functions.dates import *  # noqa: F401,F403
from wayline.functions.hashing import *  # noqa: F401,F403
from wayline.functions.numbers import *  # noqa: F401,F403
from wayline.functions.text import *  # noqa: F401,F403
