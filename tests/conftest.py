import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from nestgate.session import checkpoint_root, local_session

    s = local_session(cores="*", shuffle_partitions=8)
    checkpoint_root(s)
    yield s


@pytest.fixture(scope="session")
def fixture_paths(tmp_path_factory):
    from fixtures import write_fixture

    return write_fixture(tmp_path_factory.mktemp("collection"))


@pytest.fixture(scope="session")
def terms_xml(spark, fixture_paths):
    from nestgate.plans.collection import harvest_terminology_xml

    return harvest_terminology_xml(spark, fixture_paths["xml_terms"]).cache()


@pytest.fixture(scope="session")
def objects_xml(spark, fixture_paths):
    from nestgate.plans.collection import harvest_objects_xml

    return harvest_objects_xml(spark, fixture_paths["xml_objects"]).cache()


@pytest.fixture(scope="session")
def enriched(terms_xml, objects_xml):
    from nestgate.plans.collection import enrich_objects

    return enrich_objects(terms_xml, objects_xml).cache()
