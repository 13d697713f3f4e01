"""Operators of a training-data pipeline. Nothing else in the package imports this."""

import os

# The models multiply many small matrices; threads inside one product only get in each other's
# way (Spark runs one task per core). It counts for a numpy that is not loaded yet.
os.environ.setdefault("OMP_NUM_THREADS", "1")
