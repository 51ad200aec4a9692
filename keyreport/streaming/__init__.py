"""Event-time windows, watermarks and stream runs. The window functions take
and give DataFrames and serve batch and streaming frames alike."""

from keyreport.streaming.windows import *  # noqa: F401,F403
from keyreport.streaming.state import *  # noqa: F401,F403
