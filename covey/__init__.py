"""covey: profiling and clustering of wide tables as Spark jobs."""

from covey.params import Params
from covey.plans.scoring import run_scoring, score
from covey.plans.training import TrainingOutputs, TrainResult, run_training, train
from covey.plans.wordcount import word_count_job

__all__ = [
    "Params",
    "TrainResult",
    "TrainingOutputs",
    "run_scoring",
    "run_training",
    "score",
    "train",
    "word_count_job",
]
