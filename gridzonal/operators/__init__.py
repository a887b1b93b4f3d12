"""DataFrame-to-DataFrame operators; all lazy unless the docstring names a job."""
