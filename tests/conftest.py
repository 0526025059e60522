import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelproj.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    # Interpreted expressions: the frames are tiny, compiling their stages would take most of the time.
    quick = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    return build_session("local[8]", 4, "tests", **{"spark.checkpoint.dir": shared, "spark.driver.memory": "8g"}, **quick)


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples, floats rounded."""

    def collect(df, *columns, digits=6):
        df = df.select(*columns) if columns else df
        tidy = [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()]
        return sorted(tidy, key=lambda t: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in t))

    return collect
