"""Jobs: each reads a layer, runs operators, writes the next layer and logs the run."""
