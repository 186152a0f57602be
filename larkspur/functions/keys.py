"""Key normalisation: one named rule for each producer of exam keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drop_extension(k: Column) -> Column:
    """K5 and K4: without the last ``.ext``. A dotted key without extension loses its last part."""
    return F.regexp_replace(k, r"(?<=.)\.[^.]*$", "")


def stem_without_nii(k: Column) -> Column:
    """K1: without the last ``.ext``, then without every ``.nii``."""
    return F.replace(drop_extension(k), F.lit(".nii"), F.lit(""))


def strip_volume_suffixes(k: Column) -> Column:
    """K2: without ``.nii.gz``, ``.npz`` and ``_embedded``, in that order."""
    for part in (".nii.gz", ".npz", "_embedded"):
        k = F.replace(k, F.lit(part), F.lit(""))
    return k


def strip_npz(k: Column) -> Column:
    """K3, predictions."""
    return F.replace(k, F.lit(".npz"), F.lit(""))


def strip_nii_gz(k: Column) -> Column:
    """K3, ground truth."""
    return F.replace(k, F.lit(".nii.gz"), F.lit(""))


def latent_to_label_key(k: Column) -> Column:
    """K6: ``npz`` becomes ``nii.gz``."""
    return F.replace(k, F.lit("npz"), F.lit("nii.gz"))


def base_name_to_label_key(path: Column) -> Column:
    """K7: base name, ``.npz`` becomes ``.nii.gz``."""
    return F.replace(F.element_at(F.split(path, "/"), -1), F.lit(".npz"), F.lit(".nii.gz"))


def emitted_key(k: Column) -> Column:
    """K8: without ``.mha`` and ``.nii``."""
    return F.replace(F.replace(k, F.lit(".mha"), F.lit("")), F.lit(".nii"), F.lit(""))


def before_first_dot(k: Column) -> Column:
    """K9."""
    return F.substring_index(k, ".", 1)


RULES = {
    "k1": stem_without_nii, "k2": strip_volume_suffixes, "k3_pred": strip_npz, "k3_gt": strip_nii_gz, "k4": drop_extension, "k5": drop_extension,
    "k6": latent_to_label_key, "k7": base_name_to_label_key, "k8": emitted_key, "k9": before_first_dot,
}
