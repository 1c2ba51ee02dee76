"""DataFrame operators: pure, lazy functions unless their docstring says otherwise."""
