"""sparkfit: clean delimited records, roll them up per key, fit straight
lines, build text features and train/score text classifiers, as Spark jobs."""

__version__ = "0.1.0"
