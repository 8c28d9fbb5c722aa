"""Gates between the layers: what must be there and agree before the next layer starts."""

from __future__ import annotations

from collections.abc import Iterable

from tidewell.operators.quality import ContractError
from tidewell.plans.contracts import GOOD, Status


def layer_gate(results: dict[str, dict], wanted: Iterable[str], snapshot_id: str) -> dict:
    """Every wanted table must be good, published, named by run and load, and of one snapshot."""
    failures = []
    for name in wanted:
        found = results.get(name)
        if found is None:
            failures.append(f"{name}: no result")
            continue
        if found.get("status") not in GOOD:
            failures.append(f"{name}: status {found.get('status')}")
        if found.get("published") is not True:
            failures.append(f"{name}: not published")
        if not found.get("run_id") or not found.get("load_id"):
            failures.append(f"{name}: no run or load id")
        if found.get("snapshot_id") != snapshot_id:
            failures.append(f"{name}: snapshot {found.get('snapshot_id')}, not {snapshot_id}")
    return {"status": Status.FAILED if failures else Status.SUCCESS, "snapshot_id": snapshot_id, "failures": failures}


def require_gate(gate: dict, layer: str) -> None:
    if gate["failures"]:
        raise ContractError(f"{layer} gate: {'; '.join(gate['failures'])}")


def overall(statuses: Iterable[str]) -> Status:
    """Of the parts' states: all good, some good, none good."""
    known = list(statuses)
    good = [s for s in known if s in GOOD]
    if known and len(good) == len(known):
        return Status.SUCCESS_WITH_REJECTIONS if Status.SUCCESS_WITH_REJECTIONS in known else Status.SUCCESS
    return Status.PARTIAL_SUCCESS if good else Status.FAILED
