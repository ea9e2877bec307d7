"""Looking at physical plans."""


def main_nodes(df) -> list[str]:
    """Operator names of the main plan, without those of scalar subqueries."""
    names, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.inputPlan())
            continue
        names.append(name)
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return names


def plan_text(df) -> str:
    """The physical plan with its subqueries."""
    return df._jdf.queryExecution().executedPlan().toString()
