"""Column-expression builders: record shaping (``shaping``) and predicates
(``predicates``). Nothing here runs Python per row."""

from keyreport.functions.shaping import *  # noqa: F401,F403
from keyreport.functions.predicates import *  # noqa: F401,F403
