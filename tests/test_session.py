"""The scratch folder."""

from pathlib import Path
from urllib.parse import urlparse

from touchline import session


def test_scratch_is_shared_and_can_be_cleared(spark):
    written = session.cut_lineage(spark.range(3))
    assert written.count() == 3
    folder = Path(urlparse(session.session_dir(spark)).path)
    assert folder.is_dir() and any(folder.iterdir())
    assert session.scratch_path(spark, "rows").startswith(session.shared_dir(spark))
    session.clear_scratch(spark)
    assert not folder.exists()
