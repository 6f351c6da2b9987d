"""Make items in a thread of their own while earlier ones are used."""

from __future__ import annotations

import queue
import threading
from collections.abc import Iterator
from typing import TypeVar

Item = TypeVar("Item")

_WAIT = 0.1  # seconds until a thread looks whether its items are still wanted


def made_ahead(items: Iterator[Item], held: int = 2) -> Iterator[Item]:
    """The items in their order; at most ``held`` of them wait. What their maker raises is raised here.

    Whoever stops early closes this generator, which ends the thread.
    """
    waiting: queue.Queue = queue.Queue(held)
    unwanted = threading.Event()

    def put(*told) -> bool:
        while not unwanted.is_set():
            try:
                waiting.put(told, timeout=_WAIT)
                return True
            except queue.Full:
                continue
        return False

    def make() -> None:
        try:
            for item in items:
                if not put("item", item):
                    return
            put("end", None)
        except BaseException as e:  # belongs to the thread that uses the items
            put("error", e)

    thread = threading.Thread(target=make, daemon=True)
    thread.start()
    try:
        while True:
            kind, value = waiting.get()
            if kind == "error":
                raise value
            if kind == "end":
                return
            yield value
    finally:
        unwanted.set()
        thread.join()
