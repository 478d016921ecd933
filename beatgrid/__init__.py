"""beatgrid: incident analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame. The packages are

* ``sources``    readers, writers and input schemas
* ``functions``  column expressions (calendar, encodings, numeric helpers)
* ``operators``  relational building blocks (grains, trails, quantiles, splits, ...)
* ``plans``      the longer chains built from them (cleaning, features, dataset)
* ``learn``      Spark ML training, tuning, resampling, evaluation and scoring
"""
