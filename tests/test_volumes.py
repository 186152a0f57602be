import io
import struct
import zipfile

import numpy as np
import pytest

from larkspur.functions import volumes as N
from larkspur.sources import volumes as V


def test_mha_round_trip_and_zip(spark, tmp_path):
    x = np.arange(24).reshape(2, 3, 4) - 5
    data = V.write_mha(x, (3.0, 1.0, 0.5))
    y, spacing = V.parse_mha(data)
    assert (x == y).all() and spacing == (3.0, 1.0, 0.5)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.mha").write_bytes(data)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("deep/B.MHA", data)
    (tmp_path / "z.zip").write_bytes(buffer.getvalue())
    got = V.read_volumes(spark, str(tmp_path)).collect()
    assert len(got) == 2 and all((np.frombuffer(r["voxels"], "<f4").reshape(r["shape"]) == x).all() for r in got)


def test_nifti(spark):
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, 2, 3, 4, 1, 1, 1, 1)
    struct.pack_into("<h", head, 70, 4)
    struct.pack_into("<8f", head, 76, 1, 0.5, 0.6, 2, 1, 1, 1, 1)
    struct.pack_into("<3f", head, 108, 352, 2, -1)
    x = np.arange(24, dtype="<i2")
    y, spacing = V.parse_nifti(bytes(head) + x.tobytes())
    assert y.shape == (2, 3, 4) and y[1, 0, 0] == 1 and spacing == pytest.approx((0.5, 0.6, 2.0))


def test_npz(spark, tmp_path):
    np.savez(tmp_path / "k.npz", arr=np.array([[1.0, 2.0]]))
    r = V.read_npz(spark, str(tmp_path)).first()
    assert (r["key"], r["vector"]) == ("k", [1.0, 2.0])


def test_steps():
    x = np.arange(2 * 4 * 4, dtype=np.float32).reshape(2, 4, 4)
    assert N.centre_fit(x, (4, 2, 2)).shape == (4, 2, 2) and N.centre_fit(x, (4, 4, 4))[0].max() == -1
    assert N.end_fit(x, (3, 4, 4))[2].max() == 0
    assert N.resize(x, (2, 2, 2))[0, 0, 0] == pytest.approx(x[0, :2, :2].mean())
    assert N.resample(x, (2.0, 1.0, 1.0), (1.0, 1.0, 1.0)).shape == (4, 4, 4)
    assert N.slice_triples(np.zeros((7, 2, 2))).shape == (2, 3, 2, 2)
    assert N.scale(np.array([-1000.0, 1000.0]), -1000, 1000, centre=True).tolist() == [-1, 1]
    assert N.median3(np.full((3, 3, 3), 5.0)).tolist() == np.full((3, 3, 3), 5.0).tolist()
    assert len(N.full_slices(np.stack([np.zeros((2, 2)), np.ones((2, 2))]), 0.5)) == 1
    assert N.min_max(np.ones(3)).tolist() == [0, 0, 0] and abs(N.z_score(x).mean()) < 1e-6
    assert N.as_rgb(np.array([0.0, 2.0])).tolist() == [[0, 0, 0], [255, 255, 255]]
    assert [p for p, *_ in N.planes(np.zeros((2, 2, 2)))] == ["xy", "xy", "xz", "xz", "yz", "yz"]
    assert N.image_errors(x, x)[1] is None and N.image_errors(x, x + 1, 31)[0] == 1
    assert N.augment(x, 3).shape == (2, 4, 4) and N.cast_frames(x, 3).shape[0] == 3 and N.centre_crop2d(x, 2).shape == (2, 2, 2)
