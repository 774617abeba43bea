"""Tiled matrix products, and several steps in one barrier job."""

from sparkgrad.catalog.forward import _Z1, digits
from sparkgrad.catalog.loops import DIGIT_START, LR, param_rows, steps_sql
from sparkgrad.catalog.registry import query, r6
from sparkgrad.plans.barrier import train_barrier
from sparkgrad.plans.tiles import dense_tiled as tiled_layer
from sparkgrad.plans.tiles import train_tiled
from sparkgrad.plans.training import Options, ParamStore


@query("dense_tiled", _Z1)
def dense_tiled(spark, sf_dir):
    """The layer as it runs when neither weights nor images fit one task."""
    images, state = digits(spark, sf_dir)
    return tiled_layer(images, state).selectExpr("id", "out AS neuron", *r6("z"))


@query("train_steps_tiled", steps_sql(*DIGIT_START, 2))
def train_steps_tiled(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return param_rows(train_tiled(images, state, ParamStore(spark), Options(lr=LR), 2))


@query("train_steps_barrier", steps_sql(*DIGIT_START, 2))
def train_steps_barrier(spark, sf_dir):
    images, state = digits(spark, sf_dir)
    return param_rows(train_barrier(images, state, ParamStore(spark), Options(lr=LR), 2))
