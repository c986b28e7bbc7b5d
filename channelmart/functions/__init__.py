"""Column builders (scalar expressions and date rules); all JVM-side."""

from channelmart.functions.exprs import *  # noqa: F401,F403
from channelmart.functions.dates import *  # noqa: F401,F403
