import sys
import warnings
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from certiscope.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warnings.simplefilter("ignore")
    session = local_session("tests", 8, memory="8g")
    yield session
    session.stop()


@pytest.fixture()
def three(spark):
    """Three certificates of two properties."""
    rows = [
        ("A", "2022-01-01", "D", "B", 55, 80, "House", "Detached", "Owner-occupied",
         "Cavity wall, as built, no insulation", "England and Wales: 1930-1949", 90.0, 4),
        ("A", "2020-06-01", "D", "B", 55, 80, "House", "Detached", "Owner-occupied",
         "Solid brick", "England and Wales: 1967-1975", 90.0, 4),
        ("B", "2021-03-15", "C", "B", 70, 80, "Flat", "Mid-Terrace", "Rental (private)",
         "Cavity wall, filled", "England and Wales: 2003-2006", 55.0, 2),
    ]
    schema = (
        "UPRN string, LODGEMENT_DATE string, CURRENT_ENERGY_RATING string, POTENTIAL_ENERGY_RATING string, "
        "CURRENT_ENERGY_EFFICIENCY int, POTENTIAL_ENERGY_EFFICIENCY int, PROPERTY_TYPE string, BUILT_FORM string, "
        "TENURE string, WALLS_DESCRIPTION string, CONSTRUCTION_AGE_BAND string, TOTAL_FLOOR_AREA double, "
        "NUMBER_HABITABLE_ROOMS int"
    )
    return spark.createDataFrame(rows, schema)
