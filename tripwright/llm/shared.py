"""Objects that a worker opens once and keeps, with what they have learnt, for later tasks."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast, SparkContext, cloudpickle


def send(context: SparkContext, value: Any) -> Broadcast:
    """A broadcast of any object of this package; its class travels by value."""
    return context.broadcast({"raw": cloudpickle.dumps(value)})


def receive(sent: Broadcast) -> Any:
    held = sent.value
    if "value" not in held:
        held["value"] = pickle.loads(held.pop("raw"))
    return held["value"]
