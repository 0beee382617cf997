from paddock.functions.arrays import *  # noqa: F401,F403
from paddock.functions.hashing import *  # noqa: F401,F403
from paddock.functions.scalars import *  # noqa: F401,F403
