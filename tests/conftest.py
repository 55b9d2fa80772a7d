import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wireglean.operators.models import ModelSettings  # noqa: E402
from wireglean.plans import training  # noqa: E402
from wireglean.plans.fixtures import raw_flows  # noqa: E402
from wireglean.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def flows(spark):
    return raw_flows(spark, SF)


@pytest.fixture(scope="session")
def clean_table(spark, flows):
    from wireglean.operators.cleaning import clean
    return clean(flows)[0]


@pytest.fixture(scope="session")
def trained(clean_table):
    """All three candidates, small, through the real training job."""
    settings = ModelSettings(logistic_iterations=30, forest_trees=5, forest_depth=6, boosting_rounds=2,
                             boosting_depth=3, detector_trees=40)
    return training.train(clean_table, settings)


EXAMPLES = {
    # A mail delivery, a knock on a database port, and a burst of handshakes that nobody answers.
    "benign": dict(destination_port=993, protocol=6, flow_duration=731_000.0, total_fwd_packets=17.0,
                   total_backward_packets=13.0, total_length_of_fwd_packets=4_410.0,
                   total_length_of_bwd_packets=6_120.0, syn_flag_count=2.0, ack_flag_count=13.0),
    "scan": dict(destination_port=1433, protocol=6, flow_duration=77.0, total_fwd_packets=1.0,
                 total_backward_packets=0.0, total_length_of_fwd_packets=0.0,
                 total_length_of_bwd_packets=0.0, syn_flag_count=1.0, ack_flag_count=0.0),
    "flood": dict(destination_port=443, protocol=6, flow_duration=1_900.0, total_fwd_packets=353.0,
                  total_backward_packets=2.0, total_length_of_fwd_packets=21_886.0,
                  total_length_of_bwd_packets=0.0, syn_flag_count=353.0, ack_flag_count=2.0),
}


@pytest.fixture(scope="session")
def example_flows(spark):
    rows = [dict(kind=k, **v) for k, v in EXAMPLES.items()]
    names = list(rows[0])
    types = {"kind": "string", "destination_port": "int", "protocol": "int"}
    schema = ", ".join(f"{n} {types.get(n, 'double')}" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
