"""A run of named stages in dependency order, with retries and a guard before anything is published."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[dict], object]
    after: tuple[str, ...] = ()
    retries: int = 0
    publishes: bool = False


@dataclass
class Pipeline:
    """Results go into one context by stage name. A publishing stage runs only when asked for."""

    stages: list[Stage] = field(default_factory=list)

    def order(self) -> list[Stage]:
        by = {s.name: s for s in self.stages}
        if len(by) != len(self.stages):
            raise ValueError("stage names repeat")
        unknown = [d for s in self.stages for d in s.after if d not in by]
        if unknown:
            raise ValueError(f"unknown stages: {unknown}")
        done: list[Stage] = []
        left = list(self.stages)
        while left:
            ready = [s for s in left if all(d in {x.name for x in done} for d in s.after)]
            if not ready:
                raise ValueError(f"stages depend on each other: {[s.name for s in left]}")
            done.append(ready[0])
            left.remove(ready[0])
        return done

    def run(self, publish: bool = False, wait: float = 0.0) -> dict:
        context: dict = {}
        for s in self.order():
            if s.publishes and not publish:
                context[s.name] = None
                continue
            for attempt in range(s.retries + 1):
                try:
                    context[s.name] = s.run(context)
                    break
                except Exception:
                    if attempt == s.retries:
                        raise
                    time.sleep(wait)
        return context
