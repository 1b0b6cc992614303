"""cellar: wide-column, feed and stream operators expressed as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` (use it with
``df.transform``) or ``Column -> Column`` for scalars, so Catalyst sees one
logical plan from the scan to the write.
"""

from cellar.session import get_session, shared_path

__version__ = "0.1.0"
__all__ = ["get_session", "shared_path", "__version__"]
