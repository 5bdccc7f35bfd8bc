import pytest

from tests.conftest import rows
from tidemark.operators import registry

EXPLICIT = (
    "pos int, workspace_id string, workspace_name string, dataset_id string, dataset_name string, "
    "is_critical boolean, is_active boolean"
)
WORKSPACES = (
    "pos int, workspace_id string, workspace_name string, is_critical_default boolean, is_active boolean, "
    "exclude_datasets array<string>"
)
LISTING = "workspace_id string, item_pos int, id string, name string"


@pytest.fixture
def resolve(spark):
    def run(explicit=(), workspaces=(), listing=()):
        return rows(
            registry.resolve(
                spark.createDataFrame(list(explicit), EXPLICIT),
                spark.createDataFrame(list(workspaces), WORKSPACES),
                spark.createDataFrame(list(listing), LISTING),
            ),
            "dataset_id",
            "dataset_name",
            "workspace_id",
            "is_critical",
        )

    return run


A = (0, "ws-1", "One", "ds-a", "Alpha", True, None)
WS1, WS2 = (0, "ws-1", "One", None, None, None), (1, "ws-2", "Two", True, None, None)


def test_explicit_only(resolve):
    assert resolve([A]) == [("ds-a", "Alpha", "ws-1", True)]


def test_inactive_entries(resolve):
    assert resolve([(*A[:6], False)]) == []
    assert resolve([], [(*WS1[:4], False, None)], [("ws-1", 0, "ds-a", "x")]) == []


def test_exclude_list(resolve):
    found = resolve([], [(*WS1[:5], ["ds-b"])], [("ws-1", 0, "ds-a", "A"), ("ws-1", 1, "ds-b", "B")])
    assert found == [("ds-a", "A", "ws-1", False)]


def test_explicit_wins(resolve):
    assert resolve([A], [WS1], [("ws-1", 0, "ds-a", "other")]) == [("ds-a", "Alpha", "ws-1", True)]


def test_last_explicit_wins(resolve):
    later = (1, "ws-9", "Nine", "ds-a", "Later", False, True)
    assert resolve([A, later]) == [("ds-a", "Later", "ws-9", False)]


def test_first_workspace_wins(resolve):
    listing = [("ws-1", 0, "ds-a", "one"), ("ws-2", 0, "ds-a", "two")]
    assert resolve([], [WS1, WS2], listing) == [("ds-a", "one", "ws-1", False)]


def test_critical_default_and_names(resolve):
    listing = [("ws-2", 0, "ds-c", None), ("ws-2", 1, None, "nameless"), ("ws-2", 2, "", "empty")]
    assert resolve([], [WS2], listing) == [("ds-c", "Unknown", "ws-2", True)]


def test_empty(resolve):
    assert resolve() == []


def test_enrich_drops_unknown(spark):
    found = spark.createDataFrame([("ds-a", "Alpha", "ws-1", "One", True, True)], ", ".join(f"{c} {'boolean' if c.startswith('is') else 'string'}" for c in registry.REGISTRY_COLUMNS))
    records = spark.createDataFrame([("ds-a", "r1", "old"), ("ds-z", "r2", "old")], "dataset_id string, requestId string, workspace_id string")
    assert rows(registry.enrich(records, found), "requestId", "workspace_id", "is_critical") == [("r1", "ws-1", True)]
