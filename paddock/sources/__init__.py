from paddock.sources.models import *  # noqa: F401,F403
from paddock.sources.payloads import *  # noqa: F401,F403
from paddock.sources.sinks import *  # noqa: F401,F403
from paddock.sources.stats import *  # noqa: F401,F403
from paddock.sources.tables import *  # noqa: F401,F403
from paddock.sources.versions import *  # noqa: F401,F403
