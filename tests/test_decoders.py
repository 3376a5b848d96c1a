"""Decoders of HDF5 and video with stand-ins for the libraries, which the image lacks: what is asked of them and what becomes of it."""

import io
import sys
import types

import numpy as np
import pytest

from tracklode.functions import clips
from tracklode.sources import readers as R


def npz(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{k.replace("/", "|"): v for k, v in arrays.items()})
    return out.getvalue()


@pytest.fixture
def h5py(monkeypatch):
    class File(dict):
        def __init__(self, data, mode):
            super().__init__((k.replace("|", "/"), v) for k, v in np.load(data).items())

        __enter__ = lambda self: self
        __exit__ = lambda self, *a: None

    monkeypatch.setitem(sys.modules, "h5py", types.SimpleNamespace(File=File))


class Capture:
    """Frames saved by NumPy; the third cannot be read."""

    seeks: list[int] = []

    def __init__(self, path):
        self.frames, self.at = np.load(path), 0

    def get(self, name):
        return {"fps": 10.0, "count": len(self.frames), "width": self.frames.shape[2], "height": self.frames.shape[1]}[name]

    def set(self, name, k):
        self.seeks.append(k)
        self.at = k

    def read(self):
        self.at += 1
        return (False, None) if self.at == 3 else (True, self.frames[self.at - 1])

    def release(self):
        pass


@pytest.fixture
def cv2(monkeypatch):
    small = lambda frame, size, interpolation: frame[: size[1], : size[0]]
    names = {"CAP_PROP_FPS": "fps", "CAP_PROP_FRAME_COUNT": "count", "CAP_PROP_FRAME_WIDTH": "width", "CAP_PROP_FRAME_HEIGHT": "height", "CAP_PROP_POS_FRAMES": "at", "INTER_AREA": 3}
    monkeypatch.setitem(sys.modules, "cv2", types.SimpleNamespace(VideoCapture=Capture, resize=small, **names))
    Capture.seeks = []


def video(n=7):
    out = io.BytesIO()
    np.save(out, np.arange(n * 6 * 8 * 3, dtype=np.uint8).reshape(n, 6, 8, 3))
    return out.getvalue()


def test_steps_of_an_episode(h5py):
    joint, pose = np.arange(28.0).reshape(2, 14), np.arange(14.0).reshape(2, 7)
    data = npz(**{"joint_action/vector": joint, "endpose/left_endpose": pose, "joint_action/left_gripper": np.array([0.5, 1.0])})
    got = list(R.decode_hdf5("a", data))
    assert got == [("a", t, joint[t].tolist(), pose[t].tolist(), None, (0.5, 1.0)[t], None) for t in range(2)]
    assert list(R.decode_hdf5("b", npz(other=pose))) == []


def test_frames_of_a_video(cv2):
    rows = list(R.decode_video("v", video()))
    assert [r[1] for r in rows] == list(range(7)) and rows[2][3:] == (None, None, None) and rows[4][2] == 0.4
    assert np.frombuffer(rows[1][5], np.uint8).reshape(6, 8, 3).tolist() == np.load(io.BytesIO(video()))[1].tolist() and not Capture.seeks
    few = list(R.decode_video("v", video(), count=3, width=4))
    assert [r[1] for r in few] == [0, 3, 6] and Capture.seeks == [3, 6] and few[1][3:5] == (3, 4)


def test_probe_reads_one_frame(cv2):
    assert list(R.probe_video("v", video())) == [("v", 8, 6, 10.0, 7, 0.7, True)]


def test_a_missing_library_raises_and_a_broken_file_is_rejected(spark, monkeypatch):
    files = spark.createDataFrame([("a.npy", bytearray(b"nothing"))], "path string, content binary")
    form = "path string, t int, joint array<double>"
    assert R.decode_files(files, R.decode_npy, form).count() == 0
    (bad,) = R.rejected_files(files, R.decode_npy, form).collect()
    assert bad.path == "a.npy" and "Error" in bad.reason

    def needy(path, content):
        import no_such_library  # noqa: F401

        yield path, 0, [0.0]

    with pytest.raises(Exception, match="no_such_library"):
        R.decode_files(files, needy, form).count()


def test_frames_are_made_smaller_by_means():
    frame = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)
    got = clips.smaller(frame, 3)
    assert got.shape == (2, 3, 3) and got[0, 0, 0] == round(frame[:2, :2, 0].mean()) and clips.smaller(frame, 6) is frame
