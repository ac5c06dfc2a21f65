"""storelens: retail and event data jobs as PySpark DataFrame functions."""
