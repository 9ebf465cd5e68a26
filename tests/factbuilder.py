"""Hand-made fact rows for edge-case tests."""

from __future__ import annotations

import base64
import datetime as dt
import json

from govlake.schemas import BLOCKS, EXECUTION_OUTCOMES, RECEIPT_ACTIONS
from govlake.sources.fixtures import Facts

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(sec: int) -> dt.datetime:
    return T0 + dt.timedelta(seconds=sec)


def b64(obj) -> str:
    text = obj if isinstance(obj, str) else json.dumps(obj, separators=(",", ":"))
    return base64.b64encode(text.encode()).decode()


def ev(event: str, **data) -> str:
    return "EVENT_JSON:" + json.dumps({"standard": "venear", "event": event, "data": [data]},
                                      separators=(",", ":"))


class FactBuilder:
    def __init__(self):
        self.actions, self.outcomes, self.blocks = [], [], {}

    def call(self, receipt_id, method, args, *, receiver="v.hos.test", predecessor="u1.near", signer="u1.near",
             sec=0, index=0, status="SuccessValue", logs=(), results=None, outcome=True, height=None):
        height = height if height is not None else 1000 + sec
        self.blocks[height] = ts(sec)
        self.actions.append((
            f"{receipt_id}-{index}", height, receipt_id, signer, "ed25519:k", "1", "FunctionCall", predecessor,
            receiver, f"h{height}", "c", "a", method, 1, "0", b64(args), None, index, ts(sec)))
        if outcome and not any(o[0] == receipt_id for o in self.outcomes):
            self.outcomes.append((
                receipt_id, height, f"h{height}", "c", "0", 1, 1.0, 0.0, receiver, status, [],
                f"h{height}", None if logs is None else list(logs),
                None if results is None else json.dumps(results, separators=(",", ":")), ts(sec)))
        return self

    def facts(self, spark) -> Facts:
        blocks = [(h, f"h{h}", f"h{h - 1}", "a", t, "1", "1") for h, t in sorted(self.blocks.items())]
        return Facts(spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(self.actions, RECEIPT_ACTIONS),
                     spark.createDataFrame(self.outcomes, EXECUTION_OUTCOMES))

    def lake(self, spark, **cfg):
        from govlake.config import ContractConfig
        from govlake.plans.catalog import GovLake
        return GovLake(spark, self.facts(spark), ContractConfig(as_of=ts(86400 * 365), **cfg))
