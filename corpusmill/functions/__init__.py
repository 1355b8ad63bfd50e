"""Column functions: Column in, Column out, JVM-side unless the docstring says otherwise."""
