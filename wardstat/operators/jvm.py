"""Passes.java on the executors: compiled by the compiler that Spark has for its own plans, and sent to them as a jar."""

from __future__ import annotations

import os
import struct
import sys
import uuid
import zipfile
import zlib
from pathlib import Path

import numpy as np
from py4j.java_gateway import JavaObject
from pyspark import SparkContext, cloudpickle

# Passes in Python workers come with what packs their numbers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SOURCE = Path(__file__).with_name("Passes.java")
# By application: compiled and sent once.
_MADE: dict[str, JavaObject] = {}


def sent(*arrays) -> bytes:
    """Arrays one after the other, each with its length before; whole numbers and others in 64 bits."""
    out = []
    for array in arrays:
        flat = np.asarray(array)
        flat = np.ascontiguousarray(flat, "<f8" if flat.dtype.kind == "f" else "<i8").ravel()
        out += [struct.pack("<q", len(flat)), flat.tobytes()]
    return b"".join(out)


def passes(context: SparkContext) -> JavaObject:
    """What makes the passes by name, in the driver."""
    if context.applicationId not in _MADE:
        jvm, source = context._jvm, _SOURCE.read_text()
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.cook(source)
        path = os.path.join(context._temp_dir, f"wardstat-passes-{zlib.crc32(source.encode()):08x}.jar")
        with zipfile.ZipFile(path, "w") as jar:
            for name, code in dict(compiler.getBytecodes()).items():
                jar.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        context._jsc.addJar(path)
        none = context._gateway.new_array(jvm.java.lang.Object, 0)
        found = compiler.getClassLoader().loadClass("wardstat.trees.Passes")
        _MADE[context.applicationId] = found.getConstructors()[0].newInstance(none)
    return _MADE[context.applicationId]


def taken(context: SparkContext, found: JavaObject) -> bytes:
    """The bytes of sums, or of slices one after the other, that lie in the driver's JVM."""
    path = os.path.join(context._temp_dir, f"found-{uuid.uuid4().hex}")
    passes(context).write(found, path)
    out = Path(path).read_bytes()
    os.remove(path)
    return out
