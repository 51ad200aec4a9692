"""Writers: text lines, delimited files, tables and message streams."""

from keyreport.sinks.files import *  # noqa: F401,F403
from keyreport.sinks.streams import *  # noqa: F401,F403
