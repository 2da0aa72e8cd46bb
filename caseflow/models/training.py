"""Driver-side rules between training rounds."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class EarlyStop:
    """Stops after ``patience`` rounds without a lower loss; remembers the best round."""

    patience: int
    best_loss: float = field(default=float("inf"))
    best_round: int = 0
    rounds: int = 0
    flat: int = 0

    def improved(self, loss: float) -> bool:
        self.rounds += 1
        if loss < self.best_loss:
            self.best_loss, self.best_round, self.flat = loss, self.rounds, 0
            return True
        self.flat += 1
        return False

    @property
    def done(self) -> bool:
        return self.flat >= self.patience
