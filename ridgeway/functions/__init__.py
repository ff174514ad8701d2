from .losses import (
    LOSSES,
    BatchLoss,
    CustomLoss,
    HingeLoss,
    LogisticLoss,
    Loss,
    SoftmaxLoss,
    SquaredLoss,
    get_loss,
    linear_margin,
    quadratic_bowl,
)

__all__ = [
    "LOSSES",
    "BatchLoss",
    "CustomLoss",
    "HingeLoss",
    "LogisticLoss",
    "Loss",
    "SoftmaxLoss",
    "SquaredLoss",
    "get_loss",
    "linear_margin",
    "quadratic_bowl",
]
