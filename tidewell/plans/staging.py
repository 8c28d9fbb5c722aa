"""Staging areas: their names, states and clean-up."""

from __future__ import annotations

import hashlib
import re
import time
from enum import StrEnum

from tidewell.operators.quality import ContractError
from tidewell.plans.store import Store

LONGEST_NAME = 63
KEEP_FAILED_HOURS = 24


class Stage(StrEnum):
    ACTIVE = "ACTIVE"
    PUBLISHED = "PUBLISHED"
    FAILED = "FAILED"
    ABANDONED = "ABANDONED"
    EXPIRED = "EXPIRED"


#: Which state may follow which.
_NEXT = {Stage.ACTIVE: {Stage.PUBLISHED, Stage.FAILED, Stage.ABANDONED}, Stage.FAILED: {Stage.EXPIRED, Stage.ACTIVE}, Stage.ABANDONED: {Stage.EXPIRED}, Stage.PUBLISHED: {Stage.EXPIRED}, Stage.EXPIRED: set()}


def staging_name(target: str, run_id: str, load_id: str) -> str:
    """Readable while it is short enough, else cut and told apart by a hash."""
    clean = [re.sub(r"[^A-Za-z0-9_]", "_", x) for x in (target, run_id, load_id)]
    name = "__".join(clean)
    return name if len(name) <= LONGEST_NAME else f"{clean[0][:40]}__{hashlib.sha256(name.encode()).hexdigest()[:20]}"


class Staging:
    def __init__(self, store: Store, clock=time.time):
        self.store, self.clock = store, clock

    def _file(self, name: str) -> str:
        return f"control/staging/{name}.json"

    def open(self, target: str, run_id: str, load_id: str) -> str:
        """Creates a staging area, or takes up the one of the same load."""
        name = staging_name(target, run_id, load_id)
        if (state := self.get(name)) is None:
            self.store.put(self._file(name), {"name": name, "target": target, "state": Stage.ACTIVE, "since": self.clock(), "validated": False, "audited": False})
        elif state["state"] != Stage.ACTIVE:
            self.move(name, Stage.ACTIVE)
        return name

    def get(self, name: str) -> dict | None:
        return self.store.get(self._file(name))

    def update(self, name: str, **values) -> None:
        self.store.put(self._file(name), self.get(name) | values)

    def move(self, name: str, to: Stage) -> None:
        state = self.get(name)
        if to not in _NEXT[Stage(state["state"])]:
            raise ContractError(f"staging {name}: {state['state']} can't become {to}")
        if to is Stage.PUBLISHED and not state["validated"]:
            raise ContractError(f"staging {name} is not validated")
        self.update(name, state=to, since=self.clock())

    def clean_up(self, keep: set[str] = frozenset()) -> list[str]:
        """Removes the data of areas that are done with: published ones once audited, failed and
        abandoned ones after a day.  Active areas, and those whose data a pointer names, stay."""
        gone = []
        for file in self.store.names("control/staging"):
            state = self.store.get(f"control/staging/{file}")
            old = self.clock() - state["since"] >= KEEP_FAILED_HOURS * 3600
            done = (state["state"] == Stage.PUBLISHED and state["audited"]) or (state["state"] in (Stage.FAILED, Stage.ABANDONED) and old)
            if done and state["name"] not in keep:
                self.store.delete(f"staging/{state['name']}")
                self.move(state["name"], Stage.EXPIRED)
                gone.append(state["name"])
        return gone
