"""Clips for training: jittered frame indices and one set of augmentation parameters for all frames of a clip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.functions.chance import between, integer, normal, uniform

#: Ranges of the augmentations (degrees, shares, scale, probability of a mirror image, hue, saturation, probability and kernel sizes of a blur) and the crop's centre (share of width and height).
ROTATION, BRIGHTNESS, CONTRAST, CROP, FLIP, HUE, SATURATION, BLUR, KERNELS = 15.0, 0.3, 0.3, (0.8, 1.0), 0.5, 15, 0.3, 0.2, (3, 7)
SPREAD = 0.05


def jitter(clips: DataFrame, key: list[str], indices: str = "frame_indices", most: int = 2, total: Column | int = 1000, seed: int = 42) -> DataFrame:
    """clips with each of their frame indices moved by -most to most, kept from 0 to total - 1. The move depends on seed, key and the index's place in its clip alone; order is not restored. Null indices stay null."""
    end = (total if isinstance(total, Column) else F.lit(total)) - 1
    move = lambda x, i: F.when(x.isNotNull(), F.greatest(F.least(x + integer(-most, most, uniform(seed, *key, i)), end), F.lit(0)).cast("long"))
    return clips.withColumn(indices, F.transform(indices, move))


def parameters(clips: DataFrame, key: list[str], width: Column | int, height: Column | int, seed: int = 42) -> DataFrame:
    """clips with augment: what is done to every frame of the clip. Parts that are not drawn have the values that change nothing; kernel 0 is no blur."""
    u = lambda name: uniform(seed, *key, F.lit(name))
    w, h = (x if isinstance(x, Column) else F.lit(x) for x in (width, height))
    half = lambda name: u("do " + name) < 0.5
    crop = half("crop")
    scale = F.when(crop, between(*CROP, u("scale"))).otherwise(1.0)
    cw, ch = F.when(crop, F.floor(w * scale)).otherwise(w).cast("int"), F.when(crop, F.floor(h * scale)).otherwise(h).cast("int")
    # the centre lies a little below the middle, where hands work
    whole = lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("int")
    cx, cy = F.floor(w / 2).cast("int") + whole(normal(0.0, w * SPREAD, u("x1"), u("x2"))), F.floor(h / 2).cast("int") + whole(normal(h * SPREAD, h * SPREAD, u("y1"), u("y2")))
    inside = lambda c, size, most: F.greatest(F.least(c - F.floor(size / 2), most - size), F.lit(0)).cast("int")
    kernels = list(range(KERNELS[0], KERNELS[1] + 1, 2))
    parts = {
        "angle": F.when(half("rotate"), between(-ROTATION, ROTATION, u("angle"))).otherwise(0.0),
        "brightness": F.when(half("light"), between(-BRIGHTNESS, BRIGHTNESS, u("brightness"))).otherwise(0.0),
        "contrast": F.when(half("light"), 1 + between(-CONTRAST, CONTRAST, u("contrast"))).otherwise(1.0),
        "crop_x": F.when(crop, inside(cx, cw, w)).otherwise(0), "crop_y": F.when(crop, inside(cy, ch, h)).otherwise(0), "crop_width": cw, "crop_height": ch,
        "flip": u("flip") < FLIP,
        "hue": F.when(half("colour"), integer(-HUE, HUE, u("hue"))).otherwise(0), "saturation": F.when(half("colour"), 1 + between(-SATURATION, SATURATION, u("saturation"))).otherwise(1.0),
        "kernel": F.when(u("blur") < BLUR, F.get(F.array(*map(F.lit, kernels)), integer(0, len(kernels) - 1, u("kernel")))).otherwise(0),
    }
    return clips.withColumn("augment", F.struct(*[c.alias(k) for k, c in parts.items()]))


def mirrored(hand: Column, flip: Column) -> Column:
    """A hand's label after a mirror image: left and right change places."""
    return F.when(flip & (hand == "left"), "right").when(flip & (hand == "right"), "left").otherwise(hand)
