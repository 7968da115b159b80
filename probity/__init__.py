"""probity: exam-integrity analytics on Spark DataFrames.

Every operator takes DataFrames (plus an ``as_of`` instant where the result
depends on "now") and returns a lazy DataFrame.  Nothing is collected to the
driver inside an operator; Catalyst and AQE choose the physical plan.
"""

from probity.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
