"""Operations of a training-data pipeline. Nothing else in the library imports them.

Functions of this library that run inside tasks are pickled by value, so workers
need the third-party packages but not the library itself.
"""

from pyspark import cloudpickle

import cohortlens

cloudpickle.register_pickle_by_value(cohortlens)
