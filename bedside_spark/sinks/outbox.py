"""Deliveries that are claimed before they are made.

A task may run twice: again after a lost executor, beside a slow first run, or with its whole
batch after a restart. What it sends cannot be taken back, so before a message goes out its key is
claimed where every run looks, by a step that only one of them can win:

* no claim yet: claim, send, and note the outcome beside the claim;
* claimed and noted as sent: report it as delivered and send nothing;
* claimed without an outcome: the run that claimed it may have sent it or not. It is not sent
  again, and reported as not delivered with ``UNCONFIRMED``, for somebody to look at;
* refused by the receiver: the claim is given back, so the next batch may try again.
"""

from __future__ import annotations

import fcntl
import hashlib
import os
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol
from urllib.parse import unquote, urlsplit

import pandas as pd

UNCONFIRMED = "claimed by a run that left no outcome"
FREE, SENT, OPEN = "free", "sent", "open"


class Claims(Protocol):
    """A store with a conditional write, such as a key-value table; used on the executors."""

    def claim(self, key: str) -> str:
        """``FREE`` if the key was free and is now ours, else ``SENT`` or ``OPEN``."""

    def sent(self, key: str) -> None:
        """Note that the claimed message went out."""

    def release(self, key: str) -> None:
        """Give the claim back."""


class FolderClaims:
    """Claims as small files in a folder that all executors mount.

    A claim is a file created exclusively, its outcome what is then written to it. A file that does
    not hold the whole outcome is an open claim. Another run may be between the two: an open claim
    is looked at again for ``patience`` seconds before it counts as left open.
    """

    def __init__(self, folder: str, patience: float = 5.0):
        parts = urlsplit(folder)
        if parts.scheme not in ("", "file"):
            raise ValueError(f"give claims of your own: {parts.scheme} has no exclusive creation")
        self.folder = Path(unquote(parts.path))
        self.patience = patience

    def _path(self, key: str) -> Path:
        name = hashlib.sha256(key.encode()).hexdigest()
        return self.folder / name[:2] / name

    @staticmethod
    def _create(path: Path) -> None:
        flags = os.O_CREAT | os.O_EXCL | os.O_WRONLY
        try:
            own = os.open(path, flags)
        except FileNotFoundError:
            path.parent.mkdir(parents=True, exist_ok=True)
            own = os.open(path, flags)
        os.close(own)

    def claim(self, key: str) -> str:
        path = self._path(key)
        try:
            self._create(path)
            return FREE
        except FileExistsError:
            pass
        until = time.monotonic() + self.patience
        while True:
            try:
                if path.read_text() == SENT:
                    return SENT
            except FileNotFoundError:  # given back meanwhile
                return self.claim(key)
            if time.monotonic() >= until:
                return OPEN
            time.sleep(min(0.2, self.patience))

    def sent(self, key: str) -> None:
        # The file is there; a second one to rename would double the work on the folder.
        own = os.open(self._path(key), os.O_WRONLY)
        try:
            os.write(own, SENT.encode())
        finally:
            os.close(own)

    def release(self, key: str) -> None:
        self._path(key).unlink(missing_ok=True)


class PackedClaims(FolderClaims):
    """Claims as records of a few files in a folder that all executors mount.

    The mount's file locks (``flock``) must hold between the machines. A claim is a record of 17
    bytes, digest and state, where a file of its own takes a block and an inode. A key's files are
    named by ever more bits of its digest: when one has ``MOST`` records (four blocks), new keys go
    to the four below it. Records never move and full files get no new keys, so it is enough to
    lock one file after the other; no lock is held while a message is sent. A record cut short was
    never a claim. Claims that :class:`FolderClaims` left in the folder hold.
    """

    # All runs on a folder must agree on these.
    DIGEST, WIDTH, MOST = 16, 17, 963
    _LETTERS = {FREE: b"f", SENT: b"s", OPEN: b"o"}
    _STATES = {letter: state for state, letter in _LETTERS.items()}

    def __init__(self, folder: str, patience: float = 5.0):
        super().__init__(folder, patience)
        # Names are put together as text, which costs less than paths.
        self._root, self._own = str(self.folder), {}

    @staticmethod
    def _locked(path: str) -> int:
        """The open file; closing it gives the lock back."""
        flags = os.O_CREAT | os.O_RDWR
        try:
            own = os.open(path, flags, 0o666)
        except FileNotFoundError:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            own = os.open(path, flags, 0o666)
        try:
            fcntl.flock(own, fcntl.LOCK_EX)
        except BaseException:
            os.close(own)
            raise
        return own

    @staticmethod
    def _write(own: int, text: bytes, at: int) -> None:
        if os.pwrite(own, text, at) != len(text):
            raise OSError("a claim was cut short")

    def _find(self, records: bytes, digest: bytes) -> int:
        at = records.find(digest)
        while at > 0 and at % self.WIDTH:
            at = records.find(digest, at + 1)
        return at

    def _take(self, key: str, digest: bytes) -> str:
        """The state of the key's record; one that is free or new is ours afterwards."""
        first = int.from_bytes(digest[:8], "big")
        for bits in range(8, 65, 2):
            path = f"{self._root}/packed/{digest[0]:02x}/{bits}-{first >> (64 - bits):x}"
            own = self._locked(path)
            try:
                size = os.fstat(own).st_size
                records = os.pread(own, size - size % self.WIDTH, 0)
                at = self._find(records, digest)
                if at < 0 and len(records) >= self.MOST * self.WIDTH:
                    continue
                letter = records[at + self.DIGEST : at + self.WIDTH]
                state = FREE if at < 0 else self._STATES[letter]
                if state == FREE:
                    at = len(records) if at < 0 else at
                    self._write(own, digest + self._LETTERS[OPEN], at)
                    self._own[key] = path, at + self.DIGEST
                return state
            finally:
                os.close(own)
        raise OSError(f"no place for a claim under {self.folder}")

    def claim(self, key: str) -> str:
        digest = hashlib.sha256(key.encode()).digest()
        name = digest.hex()
        if os.access(f"{self._root}/{name[:2]}/{name}", os.F_OK):
            return super().claim(key)
        until = None
        while (state := self._take(key, digest[: self.DIGEST])) == OPEN:
            until = until or time.monotonic() + self.patience
            if time.monotonic() >= until:
                break
            time.sleep(min(0.2, self.patience))
        return state

    def _note(self, key: str, state: str) -> None:
        path, at = self._own[key]
        own = self._locked(path)
        try:
            self._write(own, self._LETTERS[state], at)
        finally:
            os.close(own)
        del self._own[key]

    def sent(self, key: str) -> None:
        if key in self._own:
            self._note(key, SENT)
        else:
            super().sent(key)

    def release(self, key: str) -> None:
        if key in self._own:
            self._note(key, FREE)
        else:
            super().release(key)


def _deliver(message: dict, send: Callable[[dict], None], claims: Claims) -> str | None:
    """Send one message unless it was claimed; the error, if any."""
    key = f"{message['patient_id']}\n{message['alert_id']}"
    state = claims.claim(key)
    if state != FREE:
        return None if state == SENT else UNCONFIRMED
    try:
        send(message)
    except Exception as exc:  # noqa: BLE001 - one message must not fail the others
        claims.release(key)
        return f"{type(exc).__name__}: {exc}"
    claims.sent(key)
    return None


def sender(send: Callable[[dict], None], claims: Claims):
    """The function of the tasks that send."""

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            errors = [_deliver(message, send, claims) for message in chunk.to_dict("records")]
            out = chunk[["patient_id", "alert_id"]].copy()
            out["delivered"] = [e is None for e in errors]
            out["error"] = errors
            yield out

    return run
