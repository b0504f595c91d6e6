"""Folder operations on the file system of the data."""


def _path(spark, path):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark, path):
    target, fs = _path(spark, path)
    return fs.exists(target)


def rename(spark, source, target):
    """Give a finished folder its final name in one step."""
    source_path, fs = _path(spark, source)
    target_path, _ = _path(spark, target)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not rename {source} to {target}")


def make_dir(spark, path):
    target, fs = _path(spark, path)
    fs.mkdirs(target)


def delete_files(spark, paths):
    for path in paths:
        target, fs = _path(spark, path)
        fs.delete(target, False)


def delete_folders(spark, paths):
    for path in paths:
        target, fs = _path(spark, path)
        fs.delete(target, True)
