"""Column builders: Column in, Column out, all evaluated inside the JVM."""

from etlkit.functions.dates import *  # noqa: F401,F403
from etlkit.functions.nested import *  # noqa: F401,F403
from etlkit.functions.text import *  # noqa: F401,F403
from etlkit.functions.values import *  # noqa: F401,F403
