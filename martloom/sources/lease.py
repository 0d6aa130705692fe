"""Leases on a process's load window: one run at a time, fenced by a sequence number.

The window of a run in progress is a record ``_open/<process>/<sequence>``,
created exclusively: of two runs that start together one gets the number, the
other finds the window busy. A run ends its record with a marker beside it,
``.closed`` after its commit or ``.released`` when it failed and knows it, so no
run ever deletes or overwrites another's record. A run that died leaves a
record that expires; the next one takes the window over under the next number,
and the former owner, should it still live, is refused at its commit.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import Protocol

LEASE = timedelta(hours=1)


class WindowBusy(RuntimeError):
    """Another run of the process holds its window; nothing has been started."""


class LeaseLost(RuntimeError):
    """Another run took the window over; this run may not commit."""


class Files(Protocol):
    """The store's small files."""

    def names(self, folder: str) -> list[str]: ...
    def load(self, path: str) -> dict: ...
    def save(self, path: str, record: dict, *, exclusive: bool) -> None: ...
    def remove(self, path: str) -> None: ...


@dataclass
class Lease:
    """A window held by this run."""

    process: str
    sequence: int
    record: dict                 # the window, with "owner" and "expires"
    taken_over: bool = False     # from a run that died without releasing it
    previous: dict | None = field(default=None, repr=False)

    @property
    def owner(self) -> str:
        return self.record["owner"]


class Leases:
    """The windows of a store. ``clock`` tells the wall time leases expire by."""

    def __init__(self, files: Files, root: str, clock: Callable[[], datetime]) -> None:
        self.files, self.root, self.clock = files, root, clock

    def _folder(self, process: str) -> str:
        return f"{self.root}/_open/{process}"

    def _last(self, process: str) -> tuple[int, set[str]]:
        names = {n for n in self.files.names(self._folder(process)) if not n.startswith((".", "_"))}
        return max((int(n.split(".")[0]) for n in names), default=0), names

    def current(self, process: str) -> tuple[dict | None, bool]:
        """The last record that no commit closed, and whether its run gave it up."""
        last, names = self._last(process)
        if not last or f"{last}.closed" in names or str(last) not in names:
            return None, False
        return self.files.load(f"{self._folder(process)}/{last}"), f"{last}.released" in names

    def acquire(self, process: str, window: Callable[[dict | None], dict], length: timedelta = LEASE) -> Lease:
        """Hold the window of ``process``: ``window`` makes the new record from
        the one a failed or dead run left (None after a commit).

        Raises :class:`WindowBusy` while another run holds an unexpired lease.
        """
        last, names = self._last(process)
        previous, released = self.current(process)
        now = self.clock()
        if previous is not None and not released and datetime.fromisoformat(previous["expires"]) > now:
            raise WindowBusy(f"{process}: run {previous['owner']} holds the window until {previous['expires']}")
        record = {**window(previous), "owner": uuid.uuid4().hex, "expires": (now + length).isoformat()}
        try:
            self.files.save(f"{self._folder(process)}/{last + 1}", record, exclusive=True)
        except Exception as fault:
            if self._last(process)[0] > last:
                raise WindowBusy(f"{process}: another run took the window first") from fault
            raise
        for name in names:  # records this one supersedes
            if int(name.split(".")[0]) < last:
                self.files.remove(f"{self._folder(process)}/{name}")
        return Lease(process, last + 1, record, previous is not None and not released, previous)

    def holds(self, lease: Lease) -> bool:
        last, names = self._last(lease.process)
        return last == lease.sequence and f"{last}.closed" not in names and f"{last}.released" not in names

    def check(self, lease: Lease) -> None:
        if not self.holds(lease):
            raise LeaseLost(f"{lease.process}: the window of run {lease.owner} was taken over")

    def renew(self, lease: Lease, length: timedelta = LEASE) -> None:
        self.check(lease)
        lease.record = {**lease.record, "expires": (self.clock() + length).isoformat()}
        self.files.save(f"{self._folder(lease.process)}/{lease.sequence}", lease.record, exclusive=False)

    def end(self, lease: Lease, *, committed: bool) -> None:
        """Close the window after a commit, or release it for the next run."""
        kind = "closed" if committed else "released"
        self.files.save(f"{self._folder(lease.process)}/{lease.sequence}.{kind}", {"owner": lease.owner}, exclusive=False)


class Heartbeat:
    """Renews a lease while a run works; a lease that is lost is left to the check before the commit."""

    def __init__(self, leases: Leases, lease: Lease, length: timedelta = LEASE) -> None:
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._beat, args=(leases, lease, length), daemon=True)

    def _beat(self, leases: Leases, lease: Lease, length: timedelta) -> None:
        while not self._stop.wait(length.total_seconds() / 3):
            try:
                leases.renew(lease, length)
            except LeaseLost:
                return

    def __enter__(self) -> "Heartbeat":
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()
