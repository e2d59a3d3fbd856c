"""terrace: layered (raw -> clean -> reporting) batch pipelines on Spark.

Everything here is DataFrame -> DataFrame or Column -> Column code that
Catalyst plans; the only Python that runs on executors is the workbook
parser in :mod:`terrace.sources.workbooks`.
"""

from terrace.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
