"""Writers and bounded result pages."""

from zoneflow.sinks.writers import *  # noqa: F403
from zoneflow.sinks.writers import __all__  # noqa: F401
